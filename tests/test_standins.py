"""The stand-ins have the rows that FIXTURES.md lists for sf 0.001."""

from __future__ import annotations

import pytest

from daypanel.plans.flow import EventRelations, Flow
from daypanel.sources.standins import VIEWS, view


def test_counts(spark, sf_dir):
    flow = Flow(EventRelations(spark, sf_dir), 40)
    assert flow.relations.prescriptions.count() == 1000 and flow.icu.count() == 600
    assert flow.icu.select("drug").distinct().count() == 100 and flow.spine.count() == 236
    assert flow.relations.admissions.count() == 15
    assert flow.static.filter("age < 18").count() == 0 and flow.static.filter("age > 89").count() == 9


def test_readings_per_item(spark, sf_dir):
    rows = view(spark, sf_dir, "fx_readings").groupBy("itemid").agg({"*": "count", "value": "count"}).collect()
    got = {r.itemid: (r["count(1)"], r["count(value)"]) for r in rows}
    assert got == {211: (210, 190), 618: (188, 176), 676: (110, 100), 678: (91, 83), 50971: (202, 181), 50813: (199, 179)}


@pytest.mark.parametrize("name", sorted(VIEWS))
def test_nothing_is_inferred(spark, sf_dir, name):
    """Opening a view runs no job: the schemas are declared."""
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup(f"open {name}", name)
    try:
        view(spark, sf_dir, name)
        assert not tracker.getJobIdsForGroup(f"open {name}")
    finally:
        spark.sparkContext._jsc.clearJobGroup()
