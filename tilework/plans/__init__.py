"""Registered queries: importing the package fills the registry."""

from . import registry  # noqa: F401
from . import catalog, contracts, grids, polygons, quality, scenes, sight, sources, spatial, streams, timelines  # noqa: F401  isort: skip
