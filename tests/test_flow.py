"""The whole flow on synthetic extracts, and the assistant with scripted clients."""

import json

import pytest
from pyspark.sql import functions as F

from covelake.operators import quality, reconcile, relational
from covelake.plans import assistant, semantic
from covelake.sources import landing, synthetic
from covelake.sources.storage import Lake
from covelake.streaming import job

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def landed(spark, tmp_path_factory):
    """Both batches as files named by batch, ingested batch by batch."""
    root = tmp_path_factory.mktemp("flow")
    lake = Lake(spark, f"file://{root}/lake")
    for batch, tables in synthetic.extracts(spark, n_clients=600).items():
        for name, df in tables.items():
            (root / "in" / name).mkdir(parents=True, exist_ok=True)
            df.toPandas().to_csv(root / "in" / name / f"{name}_batch_{batch}.csv", index=False)
    folders = {t: f"file://{root}/in/{t}" for t in ("clients", "policies", "claims")}
    assert [len(v) for v in landing.ingest_all(lake, folders, 1).values()] == [1, 1, 1]
    assert [len(v) for v in landing.ingest_all(lake, folders).values()] == [1, 1, 1] and not any(landing.ingest_all(lake, folders).values())
    return lake


def test_extracts_are_seeded(spark):
    one, two = (synthetic.extracts(spark, n_clients=300) for _ in range(2))
    for b in (1, 2):
        for t in one[b]:
            assert sorted(map(str, one[b][t].collect())) == sorted(map(str, two[b][t].collect()))
    assert sorted(map(str, one[1]["clients"].collect())) != sorted(map(str, synthetic.clients(spark, 43, 300).drop("id").collect()))


def test_flow(landed):
    """Latest versions win, stale ones don't, orphans and duplicates are found, and a rebuilt table reconciles."""
    raw = landed.read("bronze/clients")
    assert raw.where(F.col("town") == synthetic.STALE_TOWN).count() > 0 and landing.loaded(landed, "clients").count() == 2
    latest = relational.dedup_latest(raw, ["client_id"], [F.desc("updated"), F.desc("_batch_id")])
    assert quality.unique(latest, "client_id").isEmpty() and latest.where(F.col("town") == synthetic.STALE_TOWN).isEmpty() and latest.where("town = 'New Town'").count() > 5
    claims = landed.read("bronze/claims").dropDuplicates(["claim_id", "updated", "status"])
    assert landed.read("bronze/claims").count() > claims.count()
    policies = relational.dedup_latest(landed.read("bronze/policies"), ["policy_id"], [F.desc("updated"), F.desc("_batch_id")])
    assert quality.relationships(claims, "policy_id", policies, "policy_id").select("claim_id").distinct().count() == 12
    landed.overwrite("silver/clients", latest)
    specs = [reconcile.Spec("clients", ("client_id",), ("town", "segment")), reconcile.Spec("gone", ("x",)), reconcile.Spec("raw", ("client_id",))]
    found = reconcile.reconcile_all(specs, lambda n: {"clients": latest, "raw": raw}.get(n, latest), lambda n: raw if n == "raw" else landed.read(f"silver/{n}"))
    assert [r.status for r in found.values()] == ["pass", "error", "error"] and "repeat" in found["raw"].error
    naive = relational.dedup_latest(raw, ["client_id"], [F.desc("_batch_id"), F.asc("updated")])  # the last to arrive, whatever its date
    wrong = reconcile.reconcile(latest, naive, ["client_id"], ["town"])
    assert wrong.status == "fail" and wrong.columns[0].mismatches > 0 and len(wrong.samples) <= 5
    assert json.loads(reconcile.report_json(found))["clients"]["status"] == "pass" and reconcile.report_markdown(found).count("\n") == 4


def test_stream_of_batches(spark, tmp_path):
    """Generated batches: duplicates and late events are counted, the storm raises an alert, a bad line leaves nothing, reset forgets."""
    (tmp_path / "in").mkdir()
    lake = Lake(spark, f"file://{tmp_path}/lake")
    run = lambda: job.run_available(lake, f"file://{tmp_path}/in", f"file://{tmp_path}/cp", 30)
    put = lambda name, lines: (tmp_path / "in" / name).write_text("\n".join(lines) + "\n")
    for n in range(1, 5):
        lines = [json.dumps({**r.asDict(), "ts": r.ts.isoformat(), "event_type": {"DECLARED": "purchase", "PAID": "click"}[r.event_type]}) for r in synthetic.events(spark, n).collect()]
        put(f"e_{n:03d}.jsonl", lines)
        run()
    got = lake.read("stream/metrics").orderBy("batch").collect()
    assert len(got) == 4 and sum(r.duplicates for r in got) > 0 and sum(r.late for r in got) > 0 and got[-1].alerts == 1 and sum(r.alerts for r in got[:-1]) == 0
    assert lake.read("stream/events").count() == sum(r.kept for r in got)
    put("e_005.jsonl", ['{"event_id": "x", "ts": "2026-07-01T10:00:00"', "not json"])
    with pytest.raises(Exception, match="MALFORMED|FAILFAST|malformed|STREAM"):
        run()
    assert lake.read("stream/metrics").count() == 4 and lake.read("stream/events").count() == sum(r.kept for r in got)
    (tmp_path / "in" / "e_005.jsonl").unlink()
    before = lake.read("stream/events").count()
    job.process(lake, 30, 3, spark.read.schema(job.SCHEMA).json(f"file://{tmp_path}/in/e_004.jsonl"))  # a replay replaces its own work
    assert lake.read("stream/metrics").groupBy("batch").count().where("count > 1").isEmpty() and lake.read("stream/events").count() == before
    job.reset(lake, f"file://{tmp_path}/cp")
    assert not lake.exists("stream/events")


def test_appends(spark, tmp_path):
    lake = Lake(spark, f"file://{tmp_path}")
    lake.overwrite("t", spark.range(3))
    lake.append("t", spark.range(2).withColumn("x", F.lit("new")), "one")
    assert lake.append("t", spark.range(1).withColumn("x", F.lit("newer")), "one").count() == 4 and lake.read("t").where("x is null").count() == 3
    assert lake.compact("t", 1 << 30).count() == 4 and len(lake.current("t")) == 1
    assert lake.append("t", spark.range(1)).count() == 5 and lake.overwrite("t", lake.read("t").where("id = 0")).count() == 3
    assert lake.vacuum("t", 0.0) and lake.read("t").count() == 3


def test_csv_scans(spark, tmp_path):
    df = spark.sql("select 1 as a, date'2026-01-02' as d, cast(null as string) as s, 2.5 as x")
    landing.write_csv(df, f"file://{tmp_path}/out")
    got = landing.inferred(spark, [f"file://{tmp_path}/out"])
    assert dict(got.dtypes) == {"a": "int", "d": "date", "s": "string", "x": "double"} and got.first().s is None
    assert landing.typed(spark, [f"file://{tmp_path}/out"], "a int, d date, s string, x decimal(4,1)").first().d.isoformat() == "2026-01-02"
    with pytest.raises(Exception, match="MALFORMED|FAILFAST|BAD"):
        landing.typed(spark, [f"file://{tmp_path}/out"], "a date, d date, s string, x double").collect()
    (tmp_path / "w").mkdir()
    (tmp_path / "w" / "f_batch1.csv").write_text("a,b\n1,2\n")
    (tmp_path / "w" / "f_batch2.csv").write_text("b,c\n3,4\n")
    assert landing.widened(spark, f"file://{tmp_path}/w").fieldNames() == ["a", "b", "c"]
    schema = landing.widened(spark, f"file://{tmp_path}/w")
    landing.write_available(landing.stream_csv(spark, f"file://{tmp_path}/w", schema, "_rescued"), f"file://{tmp_path}/o", f"file://{tmp_path}/c")
    assert spark.read.parquet(f"file://{tmp_path}/o").where("_rescued is not null").count() == 2  # both files lack a column


def test_metrics(spark):
    got = semantic.REGISTRY.ask(spark, DATA, ["loss_ratio", "mean_premium"])
    assert got.count() == 1 and got.first().loss_ratio > 0
    for names, grain in ((["nope"], []), (["loss_ratio"], ["segment"])):
        with pytest.raises(LookupError):
            semantic.REGISTRY.ask(spark, DATA, names, grain)


class Script:
    def __init__(self, *replies):
        self.replies, self.heard = list(replies), []

    def reply(self, messages, tools):
        self.heard.append(messages[-1])
        return self.replies.pop(0)


def test_assistant(spark):
    cat = assistant.Catalog.over(spark, {t: f"{DATA}/{t}.parquet" for t in ("nation", "region")}, {"region": "five regions"})
    assert cat.columns().count() == 5 and "five regions" in cat.list_tables()
    call = lambda name, **a: assistant.Reply(calls=[(name, a)], tokens_in=1000, tokens_out=100)
    script = Script(call("describe", table="nope"), call("run_sql", sql="drop table region"), call("fly"), call("run_sql", sql="select count(*) as n from nation"), assistant.Reply("25"))
    got = assistant.converse(script, "how many nations?", cat.tools(), price=(3.0, 15.0))
    assert (got.status, got.answer, got.turns) == ("answered", "25", 5) and abs(got.cost - 4 * 0.0045) < 1e-9
    assert [m["failed"] for m in got.messages if m["role"] == "tool"] == [True, True, True, False] and '"25"' in got.messages[-2]["content"]
    assert assistant.converse(Script(*[call("list_tables")] * 9), "?", cat.tools(), budget=0.01, price=(3.0, 15.0)).status == "over budget"
    assert assistant.converse(Script(*[call("list_tables")] * 3), "?", cat.tools(), turns=3).status == "out of turns"
    legacy = cat.session.sql("select r_name as region, count(*) as n from region join nation on r_regionkey = n_regionkey group by r_name")
    good = "select r_name as region, count(n_name) as n from region join nation on r_regionkey = n_regionkey group by 1"
    script = Script(call("submit", sql="select * from secret"), call("submit", sql="select r_name as region, 1 as n from region"), call("submit", sql=good))
    outcome, sql = assistant.convert(script, "proc sql; ...", cat, legacy, ["region"], ["n"])
    assert (outcome.status, sql) == ("done", good) and "differing {'n': 5}" in script.heard[2]["content"]
