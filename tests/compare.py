"""Run queries on Spark and their SQL on DuckDB and compare whole results; usable as a script."""

from __future__ import annotations

import math
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
          "labels conversations").split()
# operators no registered query may need: pairwise joins and rows passing through Python
SHUNNED = re.compile("CartesianProduct|BroadcastNestedLoopJoin|BatchEvalPython|ArrowEvalPython|PythonUDF|InPandas|InArrow")
KINDS = {"INTEGER": "int", "BIGINT": "bigint", "DOUBLE": "double", "VARCHAR": "string", "BOOLEAN": "boolean", "DATE": "date"}


def duck(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for table in TABLES:
        con.sql(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{sf_dir}/{table}.parquet')")
    return con


def _cell(value):
    if isinstance(value, float):
        return None if math.isnan(value) else repr(value + 0.0)
    return value


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_cell(r[i]) for i in order) for r in rows), key=repr)


def compare(spark, con, sf_dir: str, name: str, query, sql: str | None) -> dict:
    start = time.time()
    df = query(spark, sf_dir)
    got = [tuple(r) for r in df.collect()]
    took = time.time() - start
    plan = df._jdf.queryExecution().executedPlan().toString()
    out = {"name": name, "rows": len(got), "spark_sec": round(took, 2), "problem": "", "shunned": sorted(set(SHUNNED.findall(plan)))}
    if sql is None:
        return out
    start = time.time()
    rel = con.execute(sql)
    want = rel.fetchall()
    out["duck_sec"] = round(time.time() - start, 2)
    columns = [d[0] for d in rel.description]
    kinds = {d[0]: KINDS.get(str(d[1]), str(d[1]).lower()) for d in rel.description}
    if sorted(columns) != sorted(df.columns):
        out["problem"] = f"columns {sorted(df.columns)} <> {sorted(columns)}"
        return out
    odd = {c: (k, kinds[c]) for c, k in df.dtypes if k != kinds[c]}
    if odd:
        out["problem"] = f"types {odd}"
    a, b = _rows(df.columns, got), _rows(columns, want)
    if a != b:
        only_a, only_b = [r for r in a if r not in set(b)][:3], [r for r in b if r not in set(a)][:3]
        out["problem"] += f" rows {len(a)} <> {len(b)}: spark {only_a} sql {only_b}"
    return out


def main() -> None:
    from __spark_entry__ import oracle_sql, queries
    from shelfwise.session import build_session

    sf = sys.argv[1]
    wanted = sys.argv[2:]
    sf_dir = f"/root/testdata/sf{sf}"
    spark = build_session("local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g",
                                         "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    con, sql = duck(sf_dir), oracle_sql()
    bad, total = 0, 0.0
    for name, query in queries().items():
        if wanted and not any(name.startswith(w) for w in wanted):
            continue
        try:
            out = compare(spark, con, sf_dir, name, query, sql.get(name))
        except Exception as error:  # report and go on with the next query
            out = {"name": name, "problem": f"{type(error).__name__}: {str(error)[:600]}"}
        total += out.get("spark_sec", 0)
        bad += bool(out["problem"])
        flag = "BAD" if out["problem"] else "ok " if name in sql else "-- "
        print(flag, name.ljust(24), out.get("rows"), out.get("spark_sec"), out.get("duck_sec"), out["problem"][:900], flush=True)
    print("problems:", bad, "spark seconds:", round(total, 1))


if __name__ == "__main__":
    main()
