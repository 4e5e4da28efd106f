"""Retention by folders: files of kept days stay as they are."""

import datetime as dt
import os

from orderlake import schemas
from orderlake.session import new_scratch_dir
from orderlake.sources import writers

AT = dt.datetime(2024, 3, 10, 12)


def listing(path):
    return {
        os.path.relpath(os.path.join(folder, f), path): os.stat(os.path.join(folder, f)).st_mtime_ns
        for folder, _, files in os.walk(path)
        for f in files
        if f.endswith(".parquet")
    }


def test_retention_touches_the_cutoff_day_only(spark, tmp_path):
    path = str(tmp_path / "log")
    rows = [
        (topic, 0, i, "k", f"v{i}", AT - dt.timedelta(hours=h))
        for topic in ("a", "b/c", "kept")
        for i, h in enumerate((1, 30, 47, 49, 60, 80, 200))
    ]
    rows += [("a", 0, 99, "k", "no time", None)]
    writers.write_log(spark.createDataFrame(rows, schemas.MESSAGES), path)
    before = listing(path)
    topics = spark.createDataFrame([("a", 1, 48), ("b/c", 1, 48), ("kept", 1, None), ("gone", 1, 5)], schemas.TOPICS)

    def retain():
        return writers.retain_log(spark, path, schemas.MESSAGES, topics, AT, new_scratch_dir(spark, "border"))

    # Of two topics the days of 80 and 200 hours ago go; that of 47 to 60 hours is the border.
    assert retain() == {"dropped": 4, "rewritten": 2}
    left = writers.read_log(spark, path, schemas.MESSAGES).collect()
    want = [r for r in rows if r[0] == "kept" or r[5] is None or r[5] >= AT - dt.timedelta(hours=48)]
    assert sorted((r.topic, r.offset, r.value) for r in left) == sorted((r[0], r[2], r[4]) for r in want)
    after = listing(path)
    border = {f for f in before if "day=2024-03-08" in f and "topic=kept" not in f}
    kept_days = {f: t for f, t in before.items() if f in after}
    assert kept_days == {f: after[f] for f in kept_days} and not border & set(kept_days)
    assert len(after) == len(kept_days) + 2
    # A second run changes no row.
    assert retain()["dropped"] == 0
    assert sorted(r.value for r in writers.read_log(spark, path, schemas.MESSAGES).collect()) == sorted(r.value for r in left)
