"""Hotspots in burns: what is read, shuffled and written for pairs whose number grows with the square of the tables."""

import datetime as dt
import random

from pyspark.sql import functions as F

from cinderframe.functions import geometry as G
from cinderframe.operators import dating
from cinderframe.sources import tables as S

DAY = dt.datetime(2000, 1, 1)


def diamond(x, y, h):
    return [[(float(x + h), float(y)), (float(x), float(y + h)), (float(x - h), float(y)), (float(x), float(y - h))]]


def spots(spark):
    rng = random.Random(2)
    rows = [(i, None if i % 17 == 0 else DAY + dt.timedelta(hours=i % 100), float(rng.randint(0, 12)), float(rng.randint(0, 12))) for i in range(600)]
    rows += [(1000 + i, DAY + dt.timedelta(hours=i), 5.0, 5.0) for i in range(50)] + [(2000, DAY, None, 5.0)]
    return spark.createDataFrame(rows, "det_id long, sat_ts timestamp_ntz, x double, y double")


def fires(spark):
    rng = random.Random(4)
    rows = [(i, f"{i:05d}", None if i % 11 == 0 else DAY + dt.timedelta(hours=rng.randint(-5, 90)), diamond(rng.randint(0, 12), rng.randint(0, 12), rng.randint(1, 4))) for i in range(40)]
    return spark.createDataFrame([*rows, (99, "00099", DAY, None), (98, "00098", DAY, diamond(900, 900, 2))], "perim_idx long, case_id string, discovery timestamp_ntz, rings array<array<struct<x:double,y:double>>>")


def pairs(df):
    return sorted(tuple(r) for r in df.select("case_id", "det_id", "sat_ts", "x", "y").collect())


def test_lists_hold_all_pairs(spark, monkeypatch):
    """Several shares of the cases and several lists of a place give the pairs of the plain join, each once, and a case is in one share."""
    monkeypatch.setattr(G, "LISTED", 8)
    want = pairs(dating.hotspots_in_burns(spots(spark), fires(spark)))
    for least, shares in ((10**9, 1), (200, 2)):
        got = [f.select("case_id", F.inline("hotspots"), "x", "y") for f in dating.listed_in_burns(spots(spark), fires(spark), least=least, each=0)]
        found = [pairs(f) for f in got]
        assert (len(found) == 1) if shares == 1 else (len(found) >= shares)
        assert sorted(sum(found, [])) == want and len(want) > 500
        cases = [{p[0] for p in f} for f in found]
        assert sum(map(len, cases)) == len(set().union(*cases))


def test_no_pairs(spark):
    found = list(dating.listed_in_burns(spots(spark).where("false"), fires(spark)))
    assert len(found) == 1 and found[0].count() == 0


def test_export_shuffles_lists(spark, tmp_path):
    """The export shuffles a row for a place and a case, not one for each hotspot, and adds a share to what is there."""
    rows = next(iter(dating.listed_in_burns(spots(spark), fires(spark))))
    n = rows.count()
    assert n < len(pairs(rows.select("case_id", F.inline("hotspots"), "x", "y")))
    for part in (rows.where("case_id < '00020'"), rows.where("case_id >= '00020'")):
        S.write_by_case(part.select("case_id", "x", "y", "hotspots"), str(tmp_path / "out"), order=("x", "y"), add=True)
    back = spark.read.schema(rows.select("case_id", "x", "y", "hotspots").schema).parquet(str(tmp_path / "out"))
    assert back.count() == n
