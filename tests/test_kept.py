"""Tables kept between steps."""

from dossier.sources.stages import kept


def test_kept_tables_are_not_broadcast(spark):
    """Files of repeated values are small however many rows they hold: what is read back from them isn't gathered at the driver."""
    rows = kept(spark.range(5000).selectExpr("id", "'x' as s"), "rows")
    for how in ("inner", "left_semi", "left_anti", "left"):
        plan = lambda t: spark.range(9000).join(t.where("s = 'x'").select("id"), "id", how)._jdf.queryExecution().executedPlan().toString()
        assert "Broadcast" not in plan(rows), how
    assert "Broadcast" in plan(kept(rows, "again", None))
