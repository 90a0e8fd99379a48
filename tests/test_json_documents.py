"""Cutting JSON documents in many tasks, against the library's parser."""

import json
import random
import zipfile

import numpy as np
import pytest
from pyspark.sql import functions as F

from doselens.sources import documents, json_documents

TRICKY = ['"', "\\", "{", "}", "[", "]", ",", "\\\\", '\\"', "é", "漢🙂", "\n", "x", " ", "}{", '"}', "results"]


def result(rng, n):
    text = lambda: "".join(rng.choices(TRICKY, k=rng.randint(0, 6)))
    return {"application_number": f"NDA{n:06}", "sponsor_name": text(), "reportnumber": text(),
            "products": [{"brand_name": text(), "active_ingredients": [{"name": text()}]}] * rng.randint(0, 3)}


def document(seed, results=40):
    rng = random.Random(seed)
    return {"other": [{"a": '"]'}, [], "x,y"], "meta": {"terms": {"a": [1, 2]}, "last_updated": f"2026-0{seed}-01"},
            "note": "]}{[\\", "results": [result(rng, n) for n in range(results)], "after": {}, "n": 3}


def dumped(seed, ascii_only=False, indent=None, results=40):
    return json.dumps(document(seed, results), ensure_ascii=ascii_only, indent=indent)


def numbers(frame):
    rows = frame.select("meta.last_updated", F.explode("results").alias("r")).select(
        "last_updated", "r.application_number", "r.sponsor_name", "r.reportnumber", F.col("r.products.brand_name").alias("b"))
    return sorted((*tuple(r)[:4], tuple(r.b or ())) for r in rows.collect())


def expected(*seeds, results=40):
    return sorted((document(s)["meta"]["last_updated"], r["application_number"], r["sponsor_name"], r["reportnumber"],
                   tuple(p["brand_name"] for p in r["products"])) for s in seeds for r in document(s, results)["results"])


@pytest.fixture
def small_splits(spark, monkeypatch):
    """Splits of a few bytes, so that they begin in strings, behind backslashes and inside characters."""
    monkeypatch.setattr(json_documents, "SCAN_BYTES", 64)
    monkeypatch.setattr(json_documents, "PART_BYTES", 37)
    monkeypatch.setattr(json_documents, "SEGMENT_PARTS", 2)
    settings = {"spark.sql.files.maxPartitionBytes": "101", "spark.sql.files.openCostInBytes": "1"}
    for name, value in settings.items():
        spark.conf.set(name, value)
    yield
    for name in settings:
        spark.conf.unset(name)


@pytest.mark.parametrize("indent", [None, 1])
def test_documents_in_many_splits(spark, tmp_path, small_splits, indent):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.json").write_text(dumped(1, False, indent, 6))
    (tmp_path / "in" / "b c.json").write_text(dumped(2, True, indent, 6) + "\n")
    found = documents.read_product_document(spark, str(tmp_path / "in"), str(tmp_path / "work"))
    assert numbers(found) == expected(1, 2, results=6)
    again = json_documents.members(spark, str(tmp_path / "in"), str(tmp_path / "work"))
    roles = {(r.role, r["count"]) for r in again.groupBy("role").count().collect()}
    assert roles == {("other[]", 6), ("meta{}", 4), ("results[]", 12), ("after{}", 2)}


def test_zips_in_many_segments(spark, tmp_path, small_splits):
    (tmp_path / "in").mkdir()
    with zipfile.ZipFile(tmp_path / "in" / "d.zip", "w", zipfile.ZIP_DEFLATED) as archive:
        archive.writestr("first.json", dumped(3, False, 1, 6))
        archive.writestr("second.json", "{}")
    (tmp_path / "in" / "e.json").write_text(dumped(4, results=6))
    found = documents.read_product_document(spark, str(tmp_path / "in"), str(tmp_path / "work"))
    assert numbers(found) == expected(3, 4, results=6)


@pytest.mark.parametrize("text", [
    '{"results": []}', ' \n{"results" : [ \n ] , "meta": {}}\n', '{"meta": [1, 2], "results": {"a": [1]}}',
    '{"results": null, "meta": "x"}', '{"Results": [{}]}', "{}",
])
def test_documents_without_results(spark, tmp_path, text):
    (tmp_path / "d.json").write_text(text)
    found = documents.read_product_document(spark, str(tmp_path / "d.json"), str(tmp_path / "work"))
    assert found.count() == 0 and found.schema["meta"].dataType.names == ["last_updated"]


@pytest.mark.parametrize("text", [
    "", "plain", '{"results": [{"a": 1}', '{"results": [{"a": "1}]}', '{"results": [1,]}', '{"results": [{]}]}',
    '[{"a": 1}]', '{"results": [{"a": 1} {"b": 2}]}', '{"results": [{}]', "PK\x03\x04",
])
def test_documents_of_another_form_fail(spark, tmp_path, text):
    (tmp_path / "d.json").write_text(text)
    with pytest.raises(Exception):  # noqa: B017
        documents.read_product_document(spark, str(tmp_path / "d.json"), str(tmp_path / "work")).collect()


def test_dates_and_repeated_fields(spark, tmp_path):
    (tmp_path / "d.json").write_bytes(
        b'\xef\xbb\xbf{"results": [{"application_number": "1"}, null], "meta": {"x": ["last_updated"], "last_updated": "2026-05-01"},'
        b' "results": [{"application_number": "2"}]}')
    found = documents.read_product_document(spark, str(tmp_path / "d.json"), str(tmp_path / "work"))
    assert {r.meta.last_updated for r in found.collect()} == {"2026-05-01"}
    assert sorted(str(r.results[0] and r.results[0].application_number) for r in found.collect()) == ["1", "2", "None"]


def test_states_of_chunks_compose():
    """However a text is cut, the states and depths are those of reading it byte by byte."""
    rng = random.Random(5)
    for _ in range(400):
        data = "".join(rng.choices(['"', "\\", "{", "}", "[", "]", ",", "a"], k=rng.randint(0, 40))).encode()
        for state in range(4):
            in_string, escaped, depth = bool(state & 2), bool(state & 1), 0
            for byte in data:
                if escaped:
                    escaped = False
                    depth += 0 if in_string else int(json_documents.STEP[byte])
                elif byte == 92:
                    escaped = True
                elif byte == 34:
                    in_string = not in_string
                elif not in_string:
                    depth += int(json_documents.STEP[byte])
            cut, at, total = sorted(rng.choices(range(len(data) + 1), k=3)), state, 0
            for a, b in zip([0, *cut], [*cut, len(data)]):
                ends, steps = json_documents.states_after(np.frombuffer(data[a:b], np.uint8))
                at, total = ends[at], total + steps[at]
            assert (at, total) == (2 * in_string + escaped, depth)
