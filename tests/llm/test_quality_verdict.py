"""The verdict of the quality rules where labels certify cutoffs, against SQL."""

import random

import duckdb
import pyarrow as pa
import pytest

from doselens.llm import oracles, queries

STRATA = {"en": 1500, "fr": 1500, "de": 120}
"""Good documents of each language; a hundred bad ones come on top."""


def rows(seed=5):
    rng = random.Random(seed)
    documents, labels = [], []
    for lang, good in STRATA.items():
        for i in range(good + 100):
            key = len(documents)
            words = [f"{lang}{rng.randint(0, 10**6)}" for _ in range(60)]
            bad = i >= good
            if bad and i % 3 == 0:
                words = [f"#{w}$%" for w in words]
            elif bad and i % 3 == 1:
                words = [w * 4 for w in words]
            elif bad:
                words = ["a b c d e f"] * 4 + words
            # Some good documents of one language are long-worded too, so that cutoff is not certified there.
            elif lang == "fr" and i % 40 == 0:
                words = [w * 4 for w in words]
            documents.append((key, " ".join(words), lang, "s", 0))
            labels.append((key, int(not bad), 0))
    return documents, labels


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    import pyarrow.parquet as pq

    place = tmp_path_factory.mktemp("quality")
    documents, labels = rows()
    for name, names, table in (
        ("documents", ["doc_id", "text", "lang", "source", "n_chars"], documents),
        ("labels", ["doc_id", "quality", "toxic"], labels),
    ):
        columns = [pa.array(c) for c in zip(*table, strict=True)]
        pq.write_table(pa.table(columns, names=names), str(place / f"{name}.parquet"))
    return str(place)


def test_verdict_equals_sql_where_it_acts(spark, folder):
    result = queries.queries()["op10_quality_rules"](spark, folder)
    database = duckdb.connect()
    for table in ("documents", "labels"):
        database.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{folder}/{table}.parquet')")
    cursor = database.execute(oracles.QUALITY)
    names = [column[0] for column in cursor.description]
    found = sorted(map(tuple, result.select(*names).collect()))
    assert found == sorted(cursor.fetchall())
    langs = {key: lang for key, _, lang, *_ in rows()[0]}
    acted = {}
    for row in result.collect():
        if not row.base_failed and not row.kept:
            acted[langs[row.doc_id]] = acted.get(langs[row.doc_id], 0) + 1
    # Both large strata have certified cutoffs, the small one has none.
    assert set(acted) == {"en", "fr"} and acted["en"] > acted["fr"] > 20
    good = {key for key, quality, _ in rows()[1] if quality}
    lost = [row.doc_id for row in result.collect() if row.doc_id in good and not row.base_failed and not row.kept]
    assert len(lost) <= 0.02 * sum(STRATA.values())
