"""Fill-in-the-middle against brute force."""

import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from doselens.llm import infill

ODD = [None, "", "\n", "\n\n", "a", "a\n", "a\nb", "x<P>y\nz", "<S>", "漢字🙂\n x\r\ny", "one. two! three? … four",
       "a b\tc\n d", "<<P\n>S>", "line\n" * 5000, "q" * 200_000]
UNITS = {
    "line": r"[^\n]*\n|[^\n]+",
    "sentence": r"[^\n.!?…。！？]*[\n.!?…。！？]|[^\n.!?…。！？]+",
    "character": r"(?s:.)",
}


def documents(spark, values):
    return spark.createDataFrame(list(enumerate(values)), "doc_id bigint, text string").repartition(3)


def expected(key, text, pattern, fim=100, spm=50):
    text = text or ""
    units = re.findall(pattern, text)
    assert "".join(units) == text
    digest = hashlib.sha256(f"7:{'' if key is None else key}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[i : i + 8], 16) for i in (0, 8, 16, 24))
    a, b = sorted((h1 % (len(units) + 1), h2 % (len(units) + 1)))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= fim:
        return len(units), "plain", None, None, text
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if h4 % 100 < spm:
        return len(units), "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return len(units), "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def rows_of(frame):
    return frame.select("doc_id", "n", "form", "prefix_chars", "middle_chars", "output").collect()


@pytest.mark.parametrize("unit", UNITS)
def test_infill_equals_brute_force(spark, unit):
    rng = random.Random(unit)
    values = ODD + ["".join(rng.choices("ab .\n!", k=rng.randint(0, 80))) for _ in range(200)]
    made = infill.infill(documents(spark, values), unit=unit)
    for row in rows_of(made):
        assert tuple(row)[1:] == expected(row.doc_id, values[row.doc_id], UNITS[unit])
    texts = documents(spark, values).select("doc_id", F.coalesce("text", F.lit("")).alias("was"))
    back = made.select("doc_id", infill.restore(F.col("output"), F.col("form")).alias("again"))
    assert back.join(texts, "doc_id").where("again != was").count() == 0


def test_words_are_units_by_blanks(spark):
    values = ["a  b　c", " x", "x ", "no"]
    made = infill.infill(documents(spark, values), unit="word")
    assert [r.n for r in sorted(rows_of(made))] == [4, 2, 1, 1]


def test_shares_of_forms(spark):
    values = ["a\nb"] * 300
    some = infill.infill(documents(spark, values), fim_percent=40, spm_percent=100)
    for row in rows_of(some):
        assert tuple(row)[1:] == expected(row.doc_id, "a\nb", UNITS["line"], 40, 100)
    assert {r.form for r in rows_of(some)} == {"plain", "spm"}


def test_odd_tables(spark):
    frame = documents(spark, ["a\nb", None]).withColumn("OUTPUT", F.lit(1)).withColumn("n", F.lit("clash"))
    nulls = frame.withColumn("doc_id", F.lit(None).cast("bigint"))
    rows = rows_of(infill.infill(nulls.unionAll(nulls)))
    assert sorted(tuple(r)[1:] for r in rows if r.output) == [expected(None, "a\nb", UNITS["line"])] * 2
    assert infill.infill(frame.limit(0)).count() == 0


def test_runs_of_bounded_length_change_nothing(spark, monkeypatch):
    values = ODD[:-2]
    whole = infill.Boundaries([v or "" for v in values], infill.UNIT_ENDS["line"]).counts.tolist()
    monkeypatch.setattr(infill, "CHARS_AT_ONCE", 3)
    runs = list(infill._runs([v or "" for v in values]))
    assert [i for a, b in runs for i in range(a, b)] == list(range(len(values)))
    parts = [infill.Boundaries([v or "" for v in values[a:b]], infill.UNIT_ENDS["line"]).counts.tolist() for a, b in runs]
    assert sum(parts, []) == whole == [len(re.findall(UNITS["line"], v or "")) for v in values]


def test_wavelet_matrix_ranks_and_selects():
    rng = np.random.default_rng(3)
    for size in (0, 1, 63, 64, 65, 1000):
        symbols = rng.integers(0, 8, size).astype(np.uint8)
        matrix = infill.WaveletMatrix(symbols)
        places = np.arange(size + 1)
        for symbol in range(8):
            counts = np.concatenate([[0], np.cumsum(symbols == symbol)])
            assert (matrix.rank(symbol, places) == counts).all()
            where = np.flatnonzero(symbols == symbol)
            assert (matrix.select(symbol, np.arange(len(where))) == where).all()
