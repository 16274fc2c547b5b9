"""Stored tables are deleted when asked for, unless a frame still reads them."""

import os

from vitrine.session import drop_tables, store_table, stored_since, stored_so_far


def test_stored_tables_are_dropped_unless_still_read(spark):
    mark = stored_so_far()
    one = store_table(spark.range(5).toDF("a"), "one")
    two = store_table(spark.range(7).toDF("a"), "two")
    paths = stored_since(mark)
    assert len(paths) == 2
    drop_tables(two.where("a > 1"), paths)
    assert not os.path.exists(paths[0].removeprefix("file:")) and two.count() == 7
    assert stored_since(mark) == paths[1:] and one.columns == ["a"]
