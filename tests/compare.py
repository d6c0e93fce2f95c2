"""Run queries beside their SQL twins: python tests/compare.py FOLDER [name ...]"""

import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.join(os.path.dirname(os.path.abspath(__file__)), ".."))

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def database(folder):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def canonical(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def cell(x):
        if isinstance(x, float):
            return "nan" if math.isnan(x) else repr(round(x, 9))
        return repr(x) if not isinstance(x, int) or isinstance(x, bool) else repr(float(x))

    return sorted(tuple(cell(row[i]) for i in order) for row in rows)


def compare(spark, con, build, sql, folder):
    df = build(spark, folder)
    got = canonical([tuple(r) for r in df.collect()], df.columns)
    cursor = con.execute(sql)
    columns = [d[0] for d in cursor.description]
    want = canonical(cursor.fetchall(), columns)
    if sorted(df.columns) != sorted(columns):
        return f"columns {sorted(df.columns)} / {sorted(columns)}", len(got)
    if got != want:
        have, need = set(got), set(want)
        extra = [r for r in got if r not in need][:2]
        missing = [r for r in want if r not in have][:2]
        return f"{len(got)} / {len(want)} rows\n   only here: {extra}\n   only SQL:  {missing}", len(got)
    return None, len(got)


if __name__ == "__main__":
    from pyspark.sql import SparkSession

    import __spark_entry__ as entry

    folder, names = sys.argv[1], sys.argv[2:]
    spark = (
        SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false").config("spark.driver.memory", "6g").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, oracle = database(folder), entry.oracle_sql()
    bad = 0
    for name, build in entry.queries().items():
        if names and name not in names:
            continue
        start = time.time()
        try:
            if name in oracle:
                problem, n = compare(spark, con, build, oracle[name], folder)
            else:
                problem, n = None, build(spark, folder).count()
        except Exception as error:
            problem, n = f"{type(error).__name__}: {str(error)[:1500]}", -1
        bad += problem is not None
        print(f"{'ok ' if problem is None else 'BAD'} {name:26s} {n:7d} rows {time.time() - start:6.2f} s {problem or ''}", flush=True)
    print("all equal" if not bad else f"{bad} differ")
