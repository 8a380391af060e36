"""Quality corpora, result logs, and the JSON in models' answers."""

import json

import pytest
from pyspark.sql import functions as F

from ledgerloom.plans import quality, translation


def test_balanced_slices():
    assert translation.balanced_slices('a {"x": "}]\\"{", "y": [1, {"z": 2}]} b [3] "{" {4') == ['{"x": "}]\\"{", "y": [1, {"z": 2}]}', "[3]"]
    assert translation.balanced_slices('} {"a": [1} [2] {"b": 1}') == ["[2]", '{"b": 1}']
    assert translation.balanced_slices("") == [] and translation.balanced_slices('"{}"') == ["{}"]


def test_analysis_takes_the_first_candidate_that_reads():
    assert translation.parse_analysis('x ```json\n{"a": 1}\n``` {"b": 2}') == {"a": 1}
    assert translation.parse_analysis('{broken {"n": {"s": "}"}} and {"b": 2}') == {"n": {"s": "}"}}
    assert translation.parse_analysis('first {not json} then {"b": [1,],}') == {"b": [1]}
    assert translation.parse_analysis("see [1, 2]", "links") == {"links": [1, 2]}
    for text in ("see [1, 2]", "nothing", ""):
        with pytest.raises(ValueError, match="no JSON"):
            translation.parse_analysis(text)


def test_responses():
    ids = {"a", "b"}
    assert translation.parse_response('{"translations": [{"id": "a", "translation": " x "}, {"id": "b", "text": "y"}, {"id": "z", "text": "q"}, 3]}', ids) == {"a": "x", "b": "y"}
    assert translation.parse_response('```\n{a: "x", "b": 2,}\n```', ids) == {"a": "x", "b": "2"}
    assert translation.parse_response(json.dumps({"translations_json": '[{"id": "a", "translated_text": "x"}]'}), ids, require_all=False) == {"a": "x"}
    with pytest.raises(ValueError, match="missing translations for ids: b"):
        translation.parse_response('[{"id": "a", "text": "x"}, {"id": "b", "text": "  "}]', ids)
    with pytest.raises(ValueError, match="no JSON"):
        translation.parse_response("sorry", ids)


def test_corpus(spark, tmp_path):
    case = {"name": "n", "category": "c", "items": [{"id": 1, "text": "t", "expected_any": ["x"]}, {"id": "2", "text": "u"}]}
    (tmp_path / "a.json").write_text(json.dumps({"cases": [case, {**case, "name": "m", "source_lang": "da"}]}, indent=1))
    rows = quality.corpus_items(spark, str(tmp_path / "a.json")).orderBy("case", "item").collect()
    assert [(r["case"], r["source_lang"], r["target_lang"], r["item"], r["expected_any"], r["forbidden_any"]) for r in rows] == [
        ("m", "da", "en", "1", ["x"], []), ("m", "da", "en", "2", [], []), ("n", "no", "en", "1", ["x"], []), ("n", "no", "en", "2", [], []),
    ]
    for text, message in (({"cases": []}, "without cases"), ({}, "without cases"), ({"cases": [{"name": "q", "category": "c", "items": []}]}, "without items: q")):
        (tmp_path / "b.json").write_text(json.dumps(text))
        with pytest.raises(Exception, match=message):
            quality.corpus_items(spark, str(tmp_path / "b.json")).collect()


def test_result_log(spark, tmp_path):
    """A run that fails leaves no line; one that is written again has each line once."""
    folder = str(tmp_path / "log")
    rows = spark.range(20).repartition(4)
    read = lambda: sorted(r["id"] for r in spark.read.schema("id long").json(folder).collect())
    quality.append_results(rows, folder, "r1")
    failing = rows.withColumn("id", F.when(F.col("id") == 13, F.raise_error(F.lit("a task fails")).cast("long")).otherwise(F.col("id") + 100))
    for run in ("r1", "r2"):
        with pytest.raises(Exception, match="a task fails"):
            quality.append_results(failing, folder, run)
        assert read() == list(range(20))
    quality.append_results(rows.withColumn("id", F.col("id") + 100), folder, "r2")
    quality.append_results(rows, folder, "r1")
    assert read() == [*range(20), *range(100, 120)]
