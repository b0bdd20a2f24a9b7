"""Ordered passes over many small groups (findings F1, F5, F6 of round 3)."""

from dossier.operators.islands import fold


def test_groups_are_passed_without_a_call_each(spark):
    """States don't leak between groups, also where a group runs over batches; one call serves a partition's groups."""
    rows = [(f"c{g % 7}", g, (i * 3) % 5 if i < 4 else None, i) for g in range(60) for i in range(5)]
    df = spark.createDataFrame(rows, "company_id string, run int, seq int, x int").repartition(3)

    def step(state, r):
        state.append(r["x"])
        return None if r["seq"] == 0 else {"seq": r["seq"], "seen": ",".join(map(str, state))}

    out = fold(df, ["company_id", "run"], ["seq"], list, step, "seq int, seen string")
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")
    try:
        got = out.collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    want = []
    for g in range(60):
        state = []
        for _, x in sorted(((99 if r[2] is None else r[2]), r[3]) for r in rows if r[1] == g):
            seq = rows[x][2]
            state.append(x)
            if seq != 0:
                want.append((f"c{g % 7}", g, seq, ",".join(map(str, state))))
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    assert "FlatMapGroups" not in plan and "MapInArrow" in plan
