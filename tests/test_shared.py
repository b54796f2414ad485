"""Tables in the shared folder."""

import os

from tessera import shared


def test_tables_are_written_and_dropped(spark):
    shared.drop_tables(spark)
    df = shared.written(spark.range(5), "five")
    path = df.inputFiles()[0].removeprefix("file://").rsplit("/", 1)[0]
    assert df.count() == 5 and os.path.isdir(path)
    assert shared.drop_tables(spark) == 1 and not os.path.exists(path)


def test_a_superseded_table_goes(spark):
    one, two = shared.written(spark.range(5), "one"), shared.written(spark.range(6), "two")
    path = one.inputFiles()[0].removeprefix("file://").rsplit("/", 1)[0]
    shared.drop(one)
    shared.drop(spark.range(3))  # not one of these tables
    assert not os.path.exists(path) and two.count() == 6


def test_tables_on_the_way_go(spark):
    made = []

    def make():
        made.append(shared.written(spark.range(9), "inner"))
        return made[0].where("id > 3")

    out = shared.settled(spark, make, "outer")
    path = made[0].inputFiles()[0].removeprefix("file://").rsplit("/", 1)[0]
    assert out.count() == 5 and not os.path.exists(path)
