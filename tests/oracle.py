"""Side-by-side runs of the named queries: ``python tests/oracle.py FOLDER [name ...]``."""

import os
import sys
import time
from collections import Counter

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402
import numpy as np  # noqa: E402
import pandas as pd  # noqa: E402

from millrace.plans.views import TABLES  # noqa: E402


def connect(folder):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def text(value):
    if isinstance(value, (list, tuple, np.ndarray)):
        return "[" + ",".join(text(v) for v in value) + "]"
    if isinstance(value, dict):
        return "{" + ",".join(f"{k}:{text(value[k])}" for k in sorted(value)) + "}"
    if isinstance(value, (float, np.floating)):
        return repr(float(value) + 0.0)
    return str(value)


def tidy(frame, names):
    """Columns by name; dates as datetimes, nested values as text."""
    out = {}
    for name in names:
        column = frame[name]
        if str(column.dtype).startswith("datetime64"):
            column = column.astype("datetime64[us]").dt.tz_localize(None)
        elif column.dtype == object:
            filled = column.dropna()
            first = filled.iloc[0] if len(filled) else None
            if isinstance(first, (list, tuple, dict, np.ndarray)):
                column = column.map(text, na_action="ignore")
            elif hasattr(first, "isoformat"):
                column = pd.to_datetime(column).astype("datetime64[us]")
        out[name] = column
    return pd.DataFrame(out)


def family(dtype):
    if isinstance(dtype, pd.StringDtype) or dtype == object:
        return "object"
    return {"i": "int", "u": "int", "f": "float", "b": "bool", "M": "time"}.get(dtype.kind, str(dtype))


def rows(frame, digits=None):
    frame = frame.astype(object).where(frame.notna(), None)
    cut = lambda x: round(float(x), digits) + 0.0 if digits is not None and isinstance(x, float) else x
    return Counter(tuple(cut(x) for x in r) for r in frame.itertuples(index=False))


def compare(spark_df, con, sql):
    """Empty text when both sides agree, else what differs."""
    names = sorted(spark_df.columns)
    left = spark_df.toArrow().to_pandas(date_as_object=False)
    right = con.execute(sql).df()
    if sorted(right.columns) != names:
        return f"columns {names} != {sorted(right.columns)}"
    if len(left) != len(right):
        return f"rows {len(left)} != {len(right)}"
    left, right = tidy(left, names), tidy(right, names)
    notes = []
    for name in names:
        a, b = family(left[name].dtype), family(right[name].dtype)
        nulls = left[name].isna().any()
        if a != b and len(left) and not (nulls and {a, b} <= {"int", "float", "object", "bool"}):
            notes.append(f"type of {name}: {a} != {b}")
        if a != b and {a, b} == {"int", "float"}:
            left[name], right[name] = left[name].astype(float), right[name].astype(float)
    same = False
    try:
        f32 = lambda f: f.infer_objects()
        hashes = [np.sort(pd.util.hash_pandas_object(f32(f), index=False).to_numpy()) for f in (left, right)]
        same = bool((hashes[0] == hashes[1]).all())
    except TypeError:
        pass
    if not same:
        a, b = rows(left), rows(right)
        if a != b:
            near = "close" if rows(left, 4) == rows(right, 4) else "DIFFERENT"
            only_a, only_b = (sorted((x - y), key=str) for x, y in ((a, b), (b, a)))
            notes.append(f"{near} values {len(only_a)}/{len(left)} {names}\n   spark {only_a[:2]}\n   sql   {only_b[:2]}")
    return "; ".join(notes)


def main(folder, wanted):
    from millrace.plans import catalog
    from millrace.session import get_session

    spark = get_session("oracle", "local[8]", 8, {"spark.ui.enabled": "false", "spark.driver.memory": "16g", "spark.driver.maxResultSize": "6g", "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(folder)
    queries, oracles = catalog.load()
    names = [n for n in queries if not wanted or any(n == w or (w.endswith("*") and n.startswith(w[:-1])) for w in wanted)]
    bad = 0
    for name in names:
        start = time.time()
        try:
            df = queries[name](spark, folder)
            if name in oracles:
                note = compare(df, con, oracles[name])
            else:
                print(f"--- {name} rows-only {df.count()} {time.time() - start:.1f}s", flush=True)
                continue
        except Exception as error:  # noqa: BLE001 - the report goes on with the next query
            note = f"ERROR {type(error).__name__}: {str(error)[:700]}"
        bad += bool(note)
        print(f"{'BAD' if note else 'ok '} {name} {time.time() - start:.1f}s {note}", flush=True)
    print(f"{len(names)} queries, {bad} bad")


if __name__ == "__main__":
    main(sys.argv[1], sys.argv[2:])
