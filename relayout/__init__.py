"""relayout: move rows between differently partitioned tables, and the batch table operators
around that job, as Spark DataFrame transformations."""

from .functions.expiry import expiry, live
from .functions.names import folded, full_match, glob_match
from .functions.predicates import Expr, equalities
from .operators.containment import layout_inventory, schema_containment
from .operators.descriptors import Descriptors, outputs_of, parse_descriptors
from .operators.job import extract, load, missing_columns, project_for_target, relayout, write_session
from .operators.lookup import (
    Resolution,
    invalidate,
    present,
    read_through,
    read_through_batch,
    record_negative,
    refresh,
    stats,
    upsert,
)
from .operators.names import all_tables, catalog_names, names_like, tables_matching
from .sources.staging import materialize, write_table
from .sources.store import compact, write_bucketed, write_by_expiry
from .sources.tables import Layout, PathTable, layout_of, path_table, read_table

__all__ = [
    "Descriptors", "Expr", "Layout", "PathTable", "Resolution", "all_tables", "catalog_names", "compact",
    "equalities", "expiry", "extract", "folded", "full_match", "glob_match", "invalidate", "layout_inventory",
    "layout_of", "live", "load", "materialize", "missing_columns", "names_like", "outputs_of", "parse_descriptors", "path_table", "present",
    "project_for_target", "read_through", "read_through_batch", "read_table", "record_negative", "refresh", "relayout", "schema_containment",
    "stats", "tables_matching", "upsert", "write_bucketed", "write_by_expiry", "write_session", "write_table",
]
