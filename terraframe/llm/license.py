"""Licence scan with a positional index of rare template words.

The index holds, for each template, the positions of its rarest words by inverse document frequency over the whole
corpus. A document's words are looked up in it; each hit proposes a place where the template would begin, hits that
agree on a place become one candidate, and the candidate is verified word by word around the mandatory key phrase.
Everything about a document happens in its own row.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .text import ascii_lower, whole

# What stands between words; a word is a run of digits, lower-case letters and characters beyond ASCII.
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
RARE_WORDS = 3
NOTICE_SHARE = 0.6


class Template(NamedTuple):
    label: str
    text: str
    key: str
    base: bool = False

    @property
    def words(self) -> list[str]:
        return self.text.split()

    @property
    def key_span(self) -> range:
        """Positions of the key phrase in the template."""
        words, key = self.words, self.key.split()
        at = next(i for i in range(len(words)) if words[i : i + len(key)] == key)
        return range(at, at + len(key))


# Phrases that count as base places, then the notices this scan knows.
TEMPLATES = [
    Template("mit", "mit license", "mit license", True),
    Template("apache", "apache license", "apache license", True),
    Template("gpl", "general public license", "general public license", True),
    Template("apache-2.0", "licensed under the apache license version 2 0", "apache license version 2 0"),
    Template("bsd", "redistribution and use in source and binary forms with or without modification are permitted",
             "redistribution and use in source and binary forms"),
    Template("cc-by-4.0", "licensed under cc by 4 0", "cc by 4 0"),
    Template("cc-by-nc-4.0", "licensed under cc by nc 4 0", "cc by nc 4 0"),
    Template("cc-by-sa-4.0", "licensed under cc by sa 4 0", "cc by sa 4 0"),
    Template("gpl-2.0", "licensed under the gnu general public license version 2", "general public license version 2"),
    Template("gpl-3.0", "licensed under the gnu general public license version 3", "general public license version 3"),
    Template("lgpl", "licensed under the gnu lesser general public license", "lesser general public license"),
    Template("mit-text", "permission is hereby granted free of charge to any person obtaining a copy of this software",
             "permission is hereby granted free of charge"),
    Template("mpl-2.0", "subject to the terms of the mozilla public license v 2 0", "mozilla public license v 2 0"),
]


def split_words(text: str | Column) -> Column:
    return F.array_remove(F.split(ascii_lower(whole(text)), BETWEEN), "")


def document_frequency(words: DataFrame, templates: list[Template]) -> dict[str, int]:
    """In how many documents each template word occurs; ``words`` has one array per document.

    At most one row per template word reaches the driver.
    """
    known = sorted({w for t in templates for w in t.words})
    found = words.select(F.explode(F.array_intersect("words", F.lit(known))).alias("word"))
    return {r.word: r.n for r in found.groupBy("word").agg(F.count("*").alias("n")).collect()}


def rare_words(templates: list[Template], frequency: dict[str, int], rare: int) -> dict[str, list[tuple[int, int]]]:
    """Postings (template, position) of each template's rarest words; words that no document has are left out."""
    postings: dict[str, list[tuple[int, int]]] = {}
    for number, t in enumerate(templates):
        present = sorted({w for w in t.words if frequency.get(w)}, key=lambda w: (frequency[w], w))
        for word in present[:rare]:
            postings.setdefault(word, []).extend((number, i) for i, w in enumerate(t.words) if w == word)
    return postings


def scan_licenses(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", templates: list[Template] = TEMPLATES,
    rare: int = RARE_WORDS, notice_share: float = NOTICE_SHARE,
) -> DataFrame:
    """One row per document: ``id_col, n_words, n_base, first_word, last_word, base_labels, labels, score, places``.

    Base templates count at every place where all their words stand. A notice gives its label where its key phrase
    stands whole and at least ``notice_share`` of its words stand at their places. ``score`` is the largest share
    of a template's words found at one place. ``places`` lists (label, first word, words found). Null and empty texts
    have no words, no places and score 0; repeated rows give repeated results; an empty table gives an empty result;
    further columns are ignored.
    """
    rows = docs.select(F.col(id_col).alias("id"), split_words(text_col).alias("words"))
    postings = rare_words(templates, document_frequency(rows, templates), rare)
    shape = "array<struct<t:int,start:int,found:int,key:boolean>>"
    places = _places(postings, templates) if postings else F.array().cast(shape)
    found = rows.select("id", F.size("words").cast("long").alias("n_words"), places.alias("p"))
    sizes, labels = F.lit([len(t.words) for t in templates]), F.lit([t.label for t in templates])
    base = F.lit([t.base for t in templates])

    def of(values: Column, p: Column) -> Column:
        return F.get(values, p["t"])

    full = F.filter("p", lambda p: of(base, p) & (p["found"] == of(sizes, p)))
    notice = F.filter("p", lambda p: ~of(base, p) & p["key"] & (p["found"] >= notice_share * of(sizes, p)))
    found = found.select("*", full.alias("b"), notice.alias("m"))

    def names(*lists: str) -> Column:
        each = F.transform(F.concat(*lists), lambda p: of(labels, p))
        return F.array_join(F.array_sort(F.array_distinct(each)), ",")

    shares = F.transform("p", lambda p: p["found"] / of(sizes, p))
    starts = F.transform("b", lambda p: p["start"].cast("long"))
    return found.select(
        F.col("id").alias(id_col), "n_words", F.size("b").cast("long").alias("n_base"),
        F.array_min(starts).alias("first_word"), F.array_max(starts).alias("last_word"),
        names("b").alias("base_labels"), names("b", "m").alias("labels"),
        F.coalesce(F.array_max(shares), F.lit(0.0)).alias("score"),
        F.transform(F.concat("b", "m"), lambda p: F.struct(
            of(labels, p).alias("label"), p["start"].alias("first_word"), p["found"].alias("found"))).alias("places"),
    )


def _places(postings: dict[str, list[tuple[int, int]]], templates: list[Template]) -> Column:
    """Candidates of a row with the number of template words that stand at their places."""
    words = F.col("words")
    index = F.create_map(*[x for w, posts in sorted(postings.items()) for x in (
        F.lit(w), F.array(*[F.struct(F.lit(t).alias("t"), F.lit(i).alias("i")) for t, i in posts]))])
    texts = F.array(*[F.lit(t.words) for t in templates])
    keys = F.array(*[F.lit(list(t.key_span)) for t in templates])
    at = F.filter(F.sequence(F.lit(0), F.size(words) - 1), lambda i: F.get(words, i).isin(*sorted(postings)))
    hits = F.when(F.size(words) > 0, at).otherwise(F.array().cast("array<int>"))
    proposed = F.array_distinct(F.flatten(F.transform(hits, lambda i: F.transform(
        F.get(F.map_values(F.map_filter(index, lambda w, _: w == F.get(words, i))), F.lit(0)),
        lambda p: F.struct(p["t"].alias("t"), (i - p["i"]).alias("start"))))))

    def stands(c: Column, j: Column) -> Column:
        return F.coalesce(F.get(words, c["start"] + j) == F.get(F.get(texts, c["t"]), j), F.lit(False))

    return F.transform(proposed, lambda c: F.struct(
        c["t"].alias("t"), c["start"].alias("start"),
        F.size(F.filter(F.sequence(F.lit(0), F.size(F.get(texts, c["t"])) - 1), lambda j: stands(c, j))).alias("found"),
        F.forall(F.get(keys, c["t"]), lambda j: stands(c, j)).alias("key")))
