"""Updates by quarter against a run over all quarters."""

from __future__ import annotations

import re
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from filingstrata import schemas
from filingstrata.plans import incremental, layers
from filingstrata.sources.tables import Lake
from helpers import frame, plan, rows
from verification.adapters import num_raw, pre_raw, sub_raw
from verification.queries import tag_arrivals

SF = "/root/testdata/sf0.001"
OPTIONS = {"pattern": "stem={stem}/folder=*", "add_missing": True, "min_year": 1997, "max_year": 2000}
SILVER = {"submissions": schemas.SUBMISSIONS, "numbers": schemas.NUMBERS, "presentations": schemas.PRESENTATIONS, "tags": schemas.TAGS[1:]}
EVERY = [(year, 1) for year in (1999, 2000, 2001)]


def write_raw(root, inputs, mode="overwrite"):
    for stem, data in inputs.items():
        named = data.withColumn("folder", F.concat("year", F.lit("q"), "quarter")).drop("year", "quarter")
        named.write.mode(mode).partitionBy("folder").parquet(f"{root}/stem={stem}")


def inputs_of(spark):
    filing = F.col("adsh").cast("long")
    stamped = {"year": (2001 - filing % 3).cast("int"), "quarter": F.lit(1)}
    made = {"sub": sub_raw, "num": num_raw, "pre": pre_raw}
    found = {stem: build(spark, SF).withColumns(stamped) for stem, build in made.items()}
    late = F.col("quarter") == 2
    tags = tag_arrivals(spark, SF).withColumns({"year": F.when(late, 2001).otherwise(1999), "quarter": F.lit(1)})
    return found | {"tag": tags}


def silver_of(lake):
    return {name: rows(lake.read("silver", name), *columns) for name, columns in SILVER.items()}


def named(fact, lake):
    """Fact rows with what their keys stand for."""
    for table, key, columns in (
        ("dim_company", "id", schemas.COMPANY_ATTRIBUTES), ("dim_pre", "id", schemas.PRE_ATTRIBUTES), ("dim_date", "id", ["ddate"]),
        ("dim_tag", "tag_id", ["tag", "version"]),
    ):
        held = lake.read("gold", table).select(F.col(key).alias(f"{table}_id"), F.to_json(F.struct(*columns)).alias(table))
        fact = fact.join(held, f"{table}_id")
    return rows(fact, "adsh", "tag", "version", "ddate", "value", "dim_company", "dim_pre", "dim_date", "dim_tag")


@pytest.fixture(scope="module")
def folders(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("quarters")
    write_raw(root / "raw", inputs_of(spark))
    whole = Lake(spark, str(root / "whole"))
    layers.run(whole, str(root / "raw"), **OPTIONS)
    return root, whole


def test_a_new_quarter_needs_no_old_numbers(spark, folders):
    """Silver is that of a whole run, keys of old rows stay, and old reported rows are neither read nor written."""
    root, whole = folders
    lake = Lake(spark, str(root / "stepwise"))
    assert incremental.update(lake, str(root / "raw"), EVERY[:2], **OPTIONS) == EVERY[:2]
    keyed = {"dim_company": "id", "dim_pre": "id", "dim_date": "id", "dim_tag": "tag_id"}
    before = {name: dict.fromkeys(rows(lake.read("gold", name))) for name in keyed}
    old = {path: path.stat().st_mtime_ns for path in Path(lake.root).glob("silver/*/year=*/quarter=*/part=reported/*.parquet")}
    for year, quarter in EVERY[:2]:
        for table in ("numbers", "presentations"):
            lake.drop_partition("bronze", table, {"year": year, "quarter": quarter})

    incremental.update(lake, str(root / "raw"), EVERY[2:], **OPTIONS)
    assert silver_of(lake) == silver_of(whole)
    for name in keyed:
        after = rows(lake.read("gold", name))
        assert len({row[0] for row in after}) == len(after)
        ids = {row[1:]: row[0] for row in after if name != "dim_tag"} or {row[1:3]: row[0] for row in after}
        for row in before[name]:
            place = row[1:3] if name == "dim_tag" else row[1:]
            assert ids.get(place, row[0]) == row[0]
        assert after[-1][0] > max(row[0] for row in before[name])
    assert old and all(path.stat().st_mtime_ns == time for path, time in old.items())
    assert named(lake.read("gold", "fact_financial"), lake) == named(whole.read("gold", "fact_financial"), whole)


def test_a_quarter_of_the_fact_is_read_by_itself(spark, folders):
    lake = Lake(spark, str(folders[0] / "stepwise"))
    one = lake.read("gold", "fact_financial", quarters=[(2001, 1)])
    assert 0 < one.count() < lake.read("gold", "fact_financial").count()
    read = {Path(row[0]).parts[-3:-1] for row in one.select(F.input_file_name()).distinct().collect()}
    assert read == {("year=2001", "quarter=1")}
    assert re.search(r"PartitionFilters: \[[^\]]*2001", plan(one))


def _small(spark, extra_numbers=(), late_owner=False, second=True):
    """Three companies over two quarters; ``B``'s filing of the first may be known in the second only."""
    sub = [("A1", 1, "a", 10, 2000, 1), ("B1", 2, "b", None, 2000, 2 if late_owner else 1), ("A2", 1, "a", None, 2000, 2)]
    num = [("A1", "T", "v", "20000101", 1, "USD", v, 2000, 1) for v in (1, 3, None)]
    num += [("B1", "T", "v", "20000101", 1, "USD", v, 2000, 1) for v in (7, None)]
    num += [("A2", "T", "v", "20000401", 1, "USD", v, 2000, 2) for v in (9, 9, 9, None)] + list(extra_numbers)
    pre = [("A1", 1, 1, "BS", "T", "v", 2000, 1), ("A2", 1, 1, None, "T", "v", 2000, 2), ("B1", 1, 2, None, "U", "v", 2000, 1)]
    tag = [("T", "v", False, 2000, 1), ("U", "v", True, 2000, 1), ("T", "v", False, 2000, 2)]
    keyed = {"year": F.col("year").cast("int"), "quarter": F.col("quarter").cast("int")}
    make = lambda schema, names, data: frame(
        spark, schema.add("year", "long").add("quarter", "long"), [*names, "year", "quarter"], data
    ).withColumns(keyed)
    from decimal import Decimal

    num = [(*row[:6], None if row[6] is None else Decimal(row[6]), *row[7:]) for row in num]
    copy = lambda schema: type(schema)(list(schema.fields))
    made = {
        "sub": make(copy(schemas.SUB_SCHEMA), ["adsh", "cik", "name", "sic"], sub),
        "num": make(copy(schemas.NUM_SCHEMA), ["adsh", "tag", "version", "ddate", "qtrs", "uom", "value"], num),
        "pre": make(copy(schemas.PRE_SCHEMA), ["adsh", "report", "line", "stmt", "tag", "version"], pre),
        "tag": make(copy(schemas.TAG_SCHEMA), ["tag", "version", "abstract"], tag),
    }
    return made


def test_replaced_quarters_late_companies_and_broken_updates(spark, tmp_path, monkeypatch):
    raw, lake = str(tmp_path / "raw"), Lake(spark, str(tmp_path / "lake"))
    write_raw(raw, _small(spark, late_owner=True))
    incremental.update(lake, raw, [(2000, 1)], **OPTIONS)
    known = rows(lake.read("silver", "numbers"), "adsh", "value", "is_value_incomplete")
    # B1 has no company yet: its gap stays open and goes, its value is flagged
    assert [(a, int(v), f) for a, v, f in known] == [("A1", 1, False), ("A1", 1, False), ("A1", 3, False), ("B1", 7, True)]

    # the second quarter is cut off before gold, and taken up again by the next update
    with monkeypatch.context() as broken:
        broken.setattr(incremental, "publish", lambda *a, **k: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError, match="lost"):
            incremental.update(lake, raw, [(2000, 2)], **OPTIONS)
    assert incremental.update(lake, raw, [(2000, 2)], **OPTIONS) == [(2000, 1), (2000, 2)]
    whole = Lake(spark, str(tmp_path / "whole"))
    layers.run(whole, raw, **OPTIONS)
    assert silver_of(lake) == silver_of(whole)
    assert named(lake.read("gold", "fact_financial"), lake) == named(whole.read("gold", "fact_financial"), whole)
    assert [int(row[0]) for row in rows(lake.read("silver", "numbers").where("adsh = 'A1'"), "value")] == [1, 3, 9]

    # the second quarter comes again without its values: the old statistics return
    again = _small(spark, late_owner=True)
    again["num"] = again["num"].where("adsh <> 'A2' or value is null")
    write_raw(raw, again)
    incremental.update(lake, raw, [(2000, 2)], **OPTIONS)
    layers.run(whole, raw, **OPTIONS)
    assert silver_of(lake) == silver_of(whole)
    assert [int(row[0]) for row in rows(lake.read("silver", "numbers").where("adsh = 'A1'"), "value")] == [1, 1, 3]
    assert lake.read("state", "pending").count() == 0


def test_changed_rows_and_asked_groups_take_one_shuffle(spark):
    after = spark.createDataFrame([("a", 1), ("a", 1), ("b", None), ("c", 3)], "k string, v int")
    before = spark.createDataFrame([("a", 1), ("b", None), ("d", 4)], "k string, v int")
    changed = incremental._differing(after, before)
    assert rows(changed) == [("a", 1), ("c", 3), ("d", 4)]  # one copy more, come, gone; NULL equals NULL
    assert plan(incremental._differing(after, before)).count("Exchange") == 1

    kind = "g string, year int, quarter int"
    old, new = (2024, 1), (2024, 2)
    own_counts = spark.createDataFrame([("counted", *new), ("both", *new), (None, *new)], kind)
    own_gaps = spark.createDataFrame([("own gap", *new)], kind)
    old_counts = spark.createDataFrame([("was counted", *new), ("elsewhere", *old)], kind)
    old_gaps = spark.createDataFrame([("both", *old), ("was counted", *old), ("replaced", *new), ("elsewhere", *old), (None, *old)], kind)
    asked = incremental._asked(own_counts, own_gaps, old_counts, old_gaps, ["g"], [new])
    assert rows(asked) == [("both",), ("own gap",), ("was counted",)]
    assert plan(incremental._asked(own_counts, own_gaps, old_counts, old_gaps, ["g"], [new])).count("Exchange") == 1
