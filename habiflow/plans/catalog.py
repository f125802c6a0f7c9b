"""Imports every catalog module so that all queries are registered."""

from habiflow.plans import catalog_clean  # noqa: F401
from habiflow.plans import catalog_raster  # noqa: F401
from habiflow.plans import catalog_quality  # noqa: F401
from habiflow.plans import catalog_sampling  # noqa: F401
from habiflow.plans import catalog_geo  # noqa: F401
from habiflow.plans import catalog_reports  # noqa: F401
from habiflow.plans import catalog_ml  # noqa: F401
from habiflow.plans import catalog_stream  # noqa: F401
from habiflow.plans import catalog_jobs  # noqa: F401
