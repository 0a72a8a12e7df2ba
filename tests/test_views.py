import datetime as dt

from helpers import tuples
from sluice.views import TestTables


def tables(spark, frame, folder):
    """A line without order, one without part and an order with two lines."""
    day = dt.date(1998, 3, 1)
    frame("l_orderkey BIGINT, l_linenumber INT, l_partkey BIGINT, l_suppkey BIGINT, l_quantity DOUBLE, "
          "l_extendedprice DOUBLE, l_discount DOUBLE, l_shipdate DATE",
          (1, 1, 5, 7, 3.0, 10.0, 0.1, day), (1, 7, 6, 7, 4.0, 20.0, 0.2, day), (2, 1, 5, 8, 1.0, 5.0, 0.0, day),
          (9, 1, 5, 7, 1.0, 5.0, 0.0, day)).write.parquet(f"{folder}/lineitem.parquet")
    frame("o_orderkey BIGINT, o_custkey BIGINT, o_orderdate DATE", (1, 11, day), (2, None, day)).write.parquet(
        f"{folder}/orders.parquet")
    frame("p_partkey BIGINT, p_size INT", (5, 2)).write.parquet(f"{folder}/part.parquet")
    return TestTables(spark, str(folder))


def test_kept_lines_are_read_in_place_of_the_join(spark, frame, tmp_path):
    views = ("viewing_history", "user_interactions", "sales_orders")
    t = tables(spark, frame, tmp_path)
    before = {name: tuples(getattr(t, name)) for name in views}
    assert [len(before[name]) for name in views] == [2, 3, 3]
    t.keep_lines()
    t.keep("viewing_history")
    assert {name: tuples(getattr(t, name)) for name in views} == before
    assert not any("/orders.parquet" in f for name in views for f in getattr(t, name).inputFiles())
    assert not any("/part.parquet" in f for f in t.viewing_history.inputFiles())
