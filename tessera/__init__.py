"""tessera: table-modelling pipelines as plain Spark DataFrame functions.

Every public function takes DataFrames (plus parameters that used to be
hand-edited literals) and returns a DataFrame. Nothing is collected to the
driver; the work is expressed with built-in Spark SQL expressions so Catalyst
can prune, push down and code-generate it.

Layout
------
``sources``    loading the driver tables and the reference-shaped stand-ins
``functions``  column-level helpers (classification, arrays, bits, JSON)
``operators``  the modelling pipelines (cumulative, SCD2, graph, datelists ...)
``plans``      physical-layout helpers (small-side joins, bucketing, layout)
``catalog``    the registered queries, each beside its DuckDB oracle SQL

Public entry points: ``tessera.operators`` (the pipelines), ``tessera.plans``
(joins and layouts), ``tessera.functions`` (column helpers),
``tessera.sources`` (readers) and ``tessera.session`` (``get_session``,
``scale_conf``, ``scratch_dir``, ``cut_lineage``).
"""

from tessera.session import get_session, scratch_dir

__all__ = ["get_session", "scratch_dir"]
