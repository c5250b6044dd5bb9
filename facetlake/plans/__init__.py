"""Named queries over the driver's tables, each beside the SQL it equals."""

from facetlake.plans import container_queries, index_queries, key_queries, raster_queries, registry_queries, source_queries
from facetlake.plans.carriers import ORACLES, QUERIES

MODULES = (key_queries, index_queries, registry_queries, raster_queries, source_queries, container_queries)


def all_queries():
    return dict(QUERIES)


def all_oracles():
    return dict(ORACLES)
