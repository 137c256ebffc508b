"""workbench: user-level analytics operators on Spark DataFrames.

Modules: ``sources`` (readers, line parsers, typed views), ``functions`` (column and plan
helpers: md5 draws, skew-safe running totals, checked broadcasts, vector maths),
``operators`` (profile, linkage, recommend, evaluate, classify, cluster, project, text),
``plans`` (analysis views, registered queries, SQL checks), ``session`` (session and
shared-folder helpers). Every operator takes and returns DataFrames.
"""
