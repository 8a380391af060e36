"""Registry runs from files and from pages of a list API, and what a writer counts."""

import json

import pytest
from pyspark.sql import functions as F

from ledgerloom.operators import upsert
from ledgerloom.plans import pulls
from ledgerloom.sources import files, paged

def now():
    return F.lit("2026-02-01 00:00:00")


def tables(spark, raw=()):
    runs = spark.createDataFrame([("e1", "running", None, None, None)], pulls.EXECUTIONS)
    return pulls.Pulled(spark.createDataFrame(list(raw), pulls.RAW), runs, spark.createDataFrame([], pulls.CHECKPOINTS))


def listed(spark, *rows):
    return spark.createDataFrame([("s", "d", str(p), "snap", "", fmt, "") for p, fmt in rows], files.FILES)


def run_of(pulled):
    e = pulled.executions.first()
    c = pulled.checkpoints.first()
    return (e["status"], e["records_written"], e["pages_fetched"], c and c["cursor"])


def test_files_of_both_kinds_in_their_order(spark, tmp_path):
    (tmp_path / "a.csv").write_text("ariregistri_kood;nimi;ettevotja_staatus_tekstina\n100;First;R\n200;Only;R\n")
    (tmp_path / "b.json").write_text(json.dumps([{"registry_code": "100", "legal_name": "Second"}]))
    for order, name in ((("a", "b"), "Second"), (("b", "a"), "First")):
        rows = [(tmp_path / ("a.csv" if x == "a" else "b.json"), "csv" if x == "a" else "json") for x in order]
        after = pulls.pull_files(spark, "ariregister", listed(spark, *rows), tables(spark), "r", "e1", now(), snapshot="20260201")
        payload = {r["native_id"]: json.loads(r["raw_payload"]) for r in after.raw.collect()}
        assert payload["100"]["legal_name"] == name and set(payload) == {"100", "200"}
        assert run_of(after) == ("completed", 2, 2, "bulk:20260201")


def test_no_files_and_unknown_modes(spark):
    none = spark.createDataFrame([], files.FILES)
    after = pulls.pull_files(spark, "cvr", none, tables(spark), "r", "e1", now())
    assert after.raw.count() == 0 and run_of(after) == ("completed", 0, 0, None)
    with pytest.raises(ValueError, match="mode"):
        pulls.pull_files(spark, "gleif", none, tables(spark), "r", "e1", now(), mode="hourly")


def row(i, h, at, run):
    return (i, h, f"p{h}", f"2026-01-{at:02d} 00:00:00", f"2026-01-{at:02d} 00:00:00", run)


def frame(spark, rows):
    text = pulls.RAW.replace("timestamp_ntz", "string")
    return spark.createDataFrame(rows, text).withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("first_seen_at", "last_seen_at")})


@pytest.mark.parametrize("force", [True, False])
def test_a_writer_counts_while_it_writes(spark, force):
    table = frame(spark, [row("a", "1", 1, "r1"), row("b", "2", 1, "r1")])
    rows = frame(spark, [row("a", "1", 5, "r2"), row("a", "1", 6, "r3"), row("b", "3", 5, "r2"), row("c", "4", 5, "r2"), row("", "9", 5, "r2")])
    after, counts = upsert.write_inputs(table, rows, "native_id", force)
    want = {(r["native_id"], r["payload_hash"], str(r["first_seen_at"]), str(r["last_seen_at"]), r["run_id"]) for r in upsert.insert_unless_known(table, rows, "native_id", force).collect()}
    assert {(r["native_id"], r["payload_hash"], str(r["first_seen_at"]), str(r["last_seen_at"]), r["run_id"]) for r in after.collect()} == want
    assert counts == ({"written": 4, "skipped": 0, "new_payloads": 2} if force else {"written": 1, "skipped": 3, "new_payloads": 1})
    none, zero = upsert.write_inputs(table.limit(0), rows.limit(0), "native_id", force)
    assert none.count() == 0 and set(zero.values()) == {0}


def test_a_writer_reads_and_shuffles_once(spark, tmp_path):
    """One scan of each table and one exchange, by the native id; an upsert after an anti-join has three."""
    for name, rows in (("t", [row("a", "1", 1, "r1")]), ("r", [row("a", "2", 2, "r2")])):
        frame(spark, rows).write.parquet(str(tmp_path / name))
    seen = []
    kept = upsert.materialize
    upsert.materialize = lambda df, tag: seen.append(df) or kept(df, tag)
    try:
        upsert.write_inputs(spark.read.parquet(str(tmp_path / "t")), spark.read.parquet(str(tmp_path / "r")), "native_id")
    finally:
        upsert.materialize = kept
    plan = seen[0]._sc._jvm.PythonSQLUtils.explainString(seen[0]._jdf.queryExecution(), "simple")
    assert plan.count("FileScan") == 2 and plan.count("Exchange hashpartitioning") == 1


def pages_of(days, size):
    """All records of a list API, and its page reader: records from a date on, in order."""
    every = [{"id": f"{d:02d}-{i}", "name": f"n{i}", "date": f"2026-01-{d:02d}"} for d in range(1, days + 1) for i in range(4)]

    def read_page(date, page):
        rest = [r for r in every if r["date"] >= date]
        return rest[page * size : (page + 1) * size]

    return every, read_page


@pytest.mark.parametrize("most_pages", [1, 3, 50])
def test_pages_in_batches(spark, tmp_path, most_pages):
    every, read_page = pages_of(7, 3)
    known = [("01-0", "h", "{}", None, None, "r0")]
    after = pulls.pull_pages(spark, "brreg", read_page, str(tmp_path / f"run{most_pages}"), tables(spark, known), "r1", "e1", "2026-01-01", now(), force=False, most_pages=most_pages, paging=paged.Paging(3, 2))
    rows = after.raw.collect()
    assert {r["native_id"] for r in rows} == {r["id"] for r in every} and len(rows) == len(every)
    assert [r["run_id"] for r in rows if r["native_id"] == "01-0"] == ["r0"]
    status, written, pages, cursor = run_of(after)
    # Days at which a date's last page ended are read again, so pages hold more records than there are.
    assert status == "completed" and written >= len(every) - 1 and pages > 28 // 3 and cursor.startswith("2026-01-")
    batches = list((tmp_path / f"run{most_pages}" / "cursor" / "commits").glob("[0-9]*"))
    assert len(batches) == -(-pages // most_pages) or len(batches) == -(-pages // most_pages) + 1


def test_pages_go_on_after_a_failure(spark, tmp_path):
    every, read_page = pages_of(6, 3)

    def flaky(date, page):
        if date >= "2026-01-04":
            raise OSError("no connection")
        return read_page(date, page)

    folder, paging = str(tmp_path / "run"), paged.Paging(3, 2)
    given = (folder, tables(spark), "r1", "e1", "2026-01-01", now())
    with pytest.raises(Exception, match="no connection"):
        pulls.pull_pages(spark, "companies_house", flaky, *given, most_pages=2, paging=paging)
    held = spark.read.schema(paged.SCHEMA).parquet(f"{folder}/pages").count()
    assert 0 < held < len(every)
    after = pulls.pull_pages(spark, "companies_house", read_page, *given, most_pages=2, paging=paging)
    assert {r["native_id"] for r in after.raw.collect()} == {r["id"] for r in every}
    again = pulls.pull_pages(spark, "companies_house", flaky, *given, most_pages=2, paging=paging)  # nothing is left to read
    assert run_of(again) == run_of(after) and again.raw.count() == len(every)


def test_all_batches_are_claimed_and_written_together(spark):
    """As one batch after another; with `most_batches` the oldest rows only."""
    from ledgerloom.plans import batches, translation

    none = lambda kind: F.lit(None).cast(kind)
    raw = spark.range(9).select(
        "id", F.concat(F.lit('{"organisasjonsform":{"beskrivelse":"T'), (F.col("id") % 3).cast("string"), F.lit('"}}')).alias("payload"), F.lit("pending").alias("status"), (-F.col("id")).alias("created_at"), F.lit(0).alias("attempts"),
        none("string").alias("error"), none("string").alias("lease_by"), none("timestamp_ntz").alias("lease_until"), none("string").alias("payload_en"), none("timestamp_ntz").alias("translated_at"),
    )
    cache = spark.createDataFrame([], "category string, original_hash string, source_lang string, target_lang string, prompt_version string, model string, original_text string, translated_text string")
    events = spark.createDataFrame([], "action_id string, status string, message string")
    start, given = batches.Tables(raw, cache, events), (batches.Settings("brreg", "w", 2, model="m"), translation.mock_translator, F.lit("2026-01-01 00:00:00").cast("timestamp_ntz"))
    step, claimed = start, []
    while True:
        step, n = batches.one_batch(step, *given)
        if not n:
            break
        claimed.append(n)
    whole, n = batches.translate_all(start, *given)
    assert claimed == [2, 2, 2, 2, 1] and n == 9
    for one, other in ((step.raw, whole.raw), (step.cache, whole.cache), (step.events, whole.events)):
        assert sorted(map(repr, one.collect())) == sorted(map(repr, other.select(one.columns).collect()))
    some, n = batches.translate_all(start, *given, most_batches=2)
    assert n == 4 and {r["id"] for r in some.raw.filter("status = 'translated'").collect()} == {5, 6, 7, 8}
