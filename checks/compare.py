"""Run a registered query and its SQL on the same tables and compare the rows."""

import math
import sys
import time

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
          "labels conversations").split()


def duck(sf_dir: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def _norm(v):
    if isinstance(v, float):
        return "NaN" if math.isnan(v) else round(v, 6) + 0.0
    if hasattr(v, "to_pydatetime"):
        return v.to_pydatetime()
    return v


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(
        (tuple(_norm(row[i]) for i in order) for row in rows), key=repr)


PAIRS = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "date": "DATE",
         "timestamp_ntz": "TIMESTAMP", "boolean": "BOOLEAN"}


def compare(spark, con, name, fn, sql, sf_dir):
    """(number of rows, None when equal or a short text saying what differs)."""
    df = fn(spark, sf_dir)
    table = df.toArrow()
    got_cols, got = _rows(df.columns, list(zip(*[c.to_pylist() for c in table.columns])) if table.num_rows else [])
    rel = con.sql(sql)
    want_cols, want = _rows(rel.columns, rel.fetchall())
    if got_cols != want_cols:
        return len(got), f"columns {got_cols} != {want_cols}"
    spark_types = {f.name: f.dataType.simpleString() for f in df.schema}
    duck_types = dict(zip(rel.columns, map(str, rel.types)))
    bad = {c: (t, duck_types[c]) for c, t in spark_types.items() if PAIRS.get(t, t) != duck_types[c]}
    if bad:
        return len(got), f"types differ: {bad}"
    if len(got) != len(want):
        return len(got), f"{len(got)} rows != {len(want)}"
    diffs = [(g, w) for g, w in zip(got, want) if g != w]
    if diffs:
        return len(got), f"{len(diffs)} of {len(got)} rows differ, first: {diffs[0]}"
    return len(got), None


def main(names, sf_dir="/root/testdata/sf0.01"):
    from checks import ORACLES, QUERIES
    from skylag.session import local_session

    spark, con = local_session(), duck(sf_dir)
    failed = 0
    for name, fn in QUERIES.items():
        if names and not any(n in name for n in names):
            continue
        t0 = time.time()
        try:
            if name in ORACLES:
                rows, problem = compare(spark, con, name, fn, ORACLES[name], sf_dir)
                note = f"{rows} rows"
            else:
                problem, note = None, f"rows only: {len(fn(spark, sf_dir).collect())}"
        except Exception as e:  # report and go on with the next query
            problem, note = str(e).split("JVM stacktrace")[0][:1500], ""
        failed += problem is not None
        print(f"{'FAIL' if problem else 'ok  '} {name:34s} {time.time()-t0:6.2f}s {note} {problem or ''}", flush=True)
    print("failed:", failed)


if __name__ == "__main__":
    main(sys.argv[1:])
