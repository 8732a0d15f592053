"""Compare Spark output types with the DuckDB oracle types for every oracle query."""
import sys
sys.path.insert(0, '/root/repo'); sys.path.insert(0, '/root/repo/tests')
from oracle_harness import duck
from offerlens.session import get_session
from __spark_entry__ import queries, oracle_sql
spark = get_session("local[8]", 8)
sf = "/root/testdata/sf0.01"
con = duck(sf)
M = {"integer": "int32", "int": "int32", "bigint": "int64", "long": "int64", "double": "float64", "float": "float64",
     "string": "str", "boolean": "bool", "timestamp_ntz": "ts", "timestamp": "ts", "date": "date",
     "INTEGER": "int32", "BIGINT": "int64", "DOUBLE": "float64", "VARCHAR": "str", "BOOLEAN": "bool",
     "TIMESTAMP": "ts", "DATE": "date", "HUGEINT": "int128", "DECIMAL": "dec", "FLOAT": "float64"}
bad = 0
for name, sql in sorted(oracle_sql().items()):
    s = {f.name: M.get(f.dataType.simpleString(), f.dataType.simpleString()) for f in queries()[name](spark, sf).schema.fields}
    d = {r[0]: M.get(r[1].split("(")[0], r[1]) for r in con.execute("DESCRIBE " + sql).fetchall()}
    diff = {k: (s.get(k), d.get(k)) for k in set(s) | set(d) if s.get(k) != d.get(k)}
    if diff:
        bad += 1
        print(name, diff, flush=True)
print("queries with type differences:", bad)
