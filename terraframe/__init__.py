"""Geospatial raster and vector analytics on Spark DataFrames."""

from .functions.geometry import Box
from .grid import Grid
from .session import local_session, shared_folder
from .sources.features import convert, load_features, options_for, register_reader, register_writer, save_features

__all__ = [
    "Box", "Grid", "convert", "load_features", "local_session", "options_for",
    "register_reader", "register_writer", "save_features", "shared_folder",
]
