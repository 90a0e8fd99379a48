"""The operators on small fixtures: brute force, round trips and odd rows."""

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from doselens.llm import bpe, components, digest, jaccard, language, mixing, quality, shards
from doselens.llm import shingles, template, toxicity, unigram

PATTERN = public_tokenizers.PATTERN
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
WORD = re.compile(r"[^\x20\x09-\x0D]+")
LONG = "the quick brown fox jumps over it " * 40_000
ODD = [None, "", " ", "\n\n", "a", "É é", "漢字🙂 x", "a b  c\r\n", "'s 12.5%%%  ", LONG]
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def documents(spark, texts, langs=None, sources=None):
    rows = [
        (i, t, (langs or ["en"] * len(texts))[i], (sources or ["s"] * len(texts))[i], len(t or ""))
        for i, t in enumerate(texts)
    ]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


def random_text(seed, words=200, alphabet="abcdefgh"):
    rng = random.Random(seed)
    return " ".join("".join(rng.choices(alphabet, k=rng.randint(2, 6))) for _ in range(words))


# Byte-level BPE


@pytest.fixture(scope="module")
def transducer():
    return bpe.Transducer(bpe.read_ranks(RANKS), state_limit=300)


@pytest.fixture(scope="module")
def library():
    ranks = bpe.read_ranks(RANKS)
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def ids_of(packed):
    return np.frombuffer(packed, "<u4").tolist()


def test_transducer_equals_the_merges(transducer, library):
    """Also with so few states that they are dropped all the time."""
    encoder = bpe.Encoder(transducer, PATTERN)
    rng = random.Random(1)
    for text in ODD[1:-1] + ["".join(rng.choices("aeioust hn'12\n\té漢🙂", k=rng.randint(1, 60))) for _ in range(3000)]:
        assert ids_of(encoder.encode(text)) == library.encode_ordinary(text)
    whole = "".join(rng.choices("etaoin", k=60_000))
    assert ids_of(transducer.encode(whole.encode())) == library.encode_ordinary(whole)


def test_streaming_decode_of_any_cut():
    text = "añ漢🙂� x" * 3
    for size in (1, 2, 3, 5, 7):
        stream = bpe.Utf8Stream()
        data = text.encode()
        parts = [stream.feed(data[i : i + size]) for i in range(0, len(data), size)]
        assert "".join(parts) + stream.close() == text
    for bad in (b"\xff", b"\xc3", b"\xe0\x80a", b"\xf0\x9f\x99", b"\xed\xa0\x80", b"a\xc0\xafb"):
        stream = bpe.Utf8Stream()
        got = "".join(stream.feed(bad[i : i + 1]) for i in range(len(bad))) + stream.close()
        assert got == bad.decode("utf-8", "replace")


def test_bpe_round_trip_on_odd_rows(spark, library):
    frame = documents(spark, ODD).withColumn("ids", F.lit("clash")).withColumn("decoded", F.lit(1))
    coded = bpe.encode(frame, RANKS, PATTERN)
    rows = bpe.decode(coded, RANKS).collect()
    assert len(rows) == len(ODD)
    for row in rows:
        text = ODD[row.doc_id] or ""
        assert row.decoded == text and ids_of(row.ids) == library.encode_ordinary(text)
        assert row.text == ODD[row.doc_id]
    assert bpe.encode(frame.limit(0), RANKS, PATTERN).count() == 0
    nulls = spark.createDataFrame([(1, None)], "doc_id int, ids binary")
    assert bpe.decode(nulls, RANKS).first().decoded == ""


# Fingerprints


def test_digest_of_equal_and_changed_texts():
    text = random_text(3, 400)
    assert digest.fingerprint(text) == digest.fingerprint(text)
    assert digest.likeness(digest.fingerprint(text), digest.fingerprint(text)) == 1
    changed, other = digest.edited(text, random_text(4, 400)), random_text(5, 400, "mnopqrstu")
    near = digest.likeness(digest.fingerprint(text), digest.fingerprint(changed))
    far = digest.likeness(digest.fingerprint(text), digest.fingerprint(other))
    assert 0 <= far < near < 1
    assert digest.fingerprint("") == digest.EMPTY == digest.fingerprint("ab")
    assert digest.likeness(digest.EMPTY, digest.fingerprint(text)) == 0


def test_long_texts_are_counted_in_parts(monkeypatch):
    data = random_text(6, 3000).encode()
    whole = digest.bucket_counts(data)
    monkeypatch.setattr(digest, "CHUNK", 777)
    assert (digest.bucket_counts(data) == whole).all()


def test_neighbours_across_tasks(spark):
    texts = [*ODD, *(random_text(i, 40) for i in range(60))]
    frame = documents(spark, texts).withColumn("fingerprint", F.lit("clash"))
    rows = {r.doc_id: r for r in digest.compare_neighbours(frame).collect()}
    assert len(rows) == len(texts)
    for i, text in enumerate(texts):
        text, following = text or "", texts[(i + 1) % len(texts)] or ""
        quarter = len(text) // 4
        edited = text[: len(text) - quarter] + following[:quarter]
        row = rows[i]
        assert row.n_chars == len(text)
        assert row.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert row.fingerprint == digest.fingerprint(text)
        assert row.near_next == digest.likeness(row.fingerprint, digest.fingerprint(following))
    assert digest.compare_neighbours(frame.limit(0)).count() == 0
    one = digest.compare_neighbours(frame.where("doc_id = 20")).collect()
    assert len(one) == 1 and one[0].near_next == 1
    twice = frame.where("doc_id in (20, 21)")
    assert digest.compare_neighbours(twice.unionAll(twice)).count() == 4
    null_id = documents(spark, ["x y z", "u v w"]).withColumn("doc_id", F.lit(None).cast("bigint"))
    assert digest.compare_neighbours(null_id).count() == 2


# Token counts


def test_unigram_counts_equal_a_search_of_all_segmentations():
    counter = unigram.Counter(public_tokenizers.path("piece_bpe_32k.model"))
    library = counter.library
    scores = {}
    for i in range(library.get_piece_size()):
        if not (library.is_unknown(i) or library.is_control(i) or library.is_byte(i)):
            scores[library.id_to_piece(i)] = library.get_score(i)
    real = [s for s in scores.values() if s > unigram.SENTINEL]
    scores = {piece: max(score, min(real) - 1) for piece, score in scores.items()}

    def brute(text):
        best = [(0.0, 0)] + [None] * len(text)
        for end in range(1, len(text) + 1):
            found = []
            for start in range(max(0, end - 20), end):
                piece = text[start:end]
                if piece in scores:
                    found.append((best[start][0] + scores[piece], best[start][1] + 1))
            if text[end - 1] not in scores:
                size = len(text[end - 1].encode())
                found.append((best[end - 1][0] + min(real) - 11, best[end - 1][1] + size))
            top = max(score for score, _ in found)
            best[end] = next(f for f in found if f[0] == top)
        return best[-1]

    rng = random.Random(2)
    for text in ODD[1:-1] + ["".join(rng.choices("theaionß é\n\t  漢🙂xqz'.", k=rng.randint(0, 60))) for _ in range(500)]:
        normal = library.normalize(text)
        score, count = brute(normal) if normal else (0.0, 0)
        assert counter.count(text) == (count, score)


def test_unigram_on_odd_rows(spark):
    path = public_tokenizers.path("piece_bpe_32k.model")
    frame = documents(spark, ODD).withColumn("N_TOKENS", F.lit("clash"))
    rows = {r.doc_id: r for r in unigram.add_counts(frame, path).collect()}
    assert rows[0].n_tokens == rows[1].n_tokens == 0 and rows[9].n_tokens > 100_000
    assert unigram.add_counts(frame.limit(0), path).count() == 0


# Toxicity


def labelled(spark, n=600):
    texts, labels = [], []
    for i in range(n):
        toxic = i % 5 == 0
        words = random_text(i, 60).split()
        if toxic:
            words[i % 50] = "scoundrel"
            words[(i * 7) % 50] = "nitwit"
        texts.append(" ".join(words))
        labels.append((i, int(toxic)))
    return documents(spark, texts), spark.createDataFrame(labels, "doc_id bigint, toxic int")


def test_toxicity_finds_held_out_rows(spark):
    frame, labels = labelled(spark)
    model = toxicity.learn(frame, labels.where("doc_id % 4 != 2"))
    rows = toxicity.add_scores(frame, model).join(labels, "doc_id").where("doc_id % 4 = 2").collect()
    wrong = sum(r.predicted != r.toxic for r in rows)
    assert wrong <= 0.02 * len(rows)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)
    again = toxicity.learn(frame.repartition(5), labels.where("doc_id % 4 != 2"))
    assert (again.weights == model.weights).all()


def test_toxicity_on_odd_rows_and_labels(spark):
    frame = documents(spark, ODD).withColumn("score", F.lit("clash"))
    none = spark.createDataFrame([], "doc_id bigint, toxic int")
    model = toxicity.learn(frame, none)
    assert {r.predicted for r in toxicity.add_scores(frame, model).collect()} == {0}
    one_class = spark.createDataFrame([(4, 1), (4, 0), (5, 1), (6, None), (7, 3)], "doc_id bigint, toxic int")
    model = toxicity.learn(frame, one_class)
    assert {r.predicted for r in toxicity.add_scores(frame, model).collect()} == {1}
    assert toxicity.add_scores(frame.limit(0), model).count() == 0


def test_ngrams_of_long_texts_do_not_depend_on_the_parts(monkeypatch):
    from doselens.llm import letters

    text = random_text(8, 500) + " Ünïcode, 12 x"
    places, grams = np.sort(toxicity.places(text)), np.sort(language.ngrams(text))
    monkeypatch.setattr(letters, "CHUNK", 50)
    assert (np.sort(toxicity.places(text)) == places).all()
    assert (np.sort(language.ngrams(text)) == grams).all()


# Token-id files


def test_elias_fano_selects_every_value():
    rng = random.Random(3)
    for values in ([], [0], [5], [0, 0, 0], list(range(3000)), sorted(rng.choices(range(10**9), k=2000)),
                   sorted(rng.choices(range(50), k=5000)), [0] * 700 + [10**12]):
        packed = shards.EliasFano.build(np.array(values, np.int64))
        again, length = shards.EliasFano.from_bytes(memoryview(packed.to_bytes()))
        assert length == len(packed.to_bytes())
        assert again.run(0, len(values) + 9).tolist() == values
        for first, count in ((0, 1), (1, 3), (len(values) // 2, 700), (len(values), 4)):
            assert again.run(first, count).tolist() == values[first : first + count]
        for i in range(0, len(values), max(1, len(values) // 97)):
            assert again.select(i) == values[i]
        with pytest.raises(IndexError):
            again.select(len(values))
    assert len(shards.EliasFano.build(np.arange(0, 10**7, 1000)).to_bytes()) < 10_000 * 13 / 8 + 64


def test_id_files_round_trip(spark, tmp_path):
    path = public_tokenizers.path("byte_bpe_50k.json")
    texts = [*ODD[:-1], "hello <|endoftext|> world", "<|endoftext|><|endoftext|>", *(random_text(i, 30) for i in range(50))]
    frame = documents(spark, texts).withColumn("start", F.lit("clash"))
    manifest = shards.write_shards(
        frame, str(tmp_path / "ids"), lambda: shards.library_encoder(path, PATTERN), shard_ids=500
    )
    assert manifest.count() > 3
    tokenizer = Tokenizer.from_file(path)
    rows = {r.doc_id: r for r in shards.read_shards(manifest).collect()}
    before = 0
    for i, text in enumerate(texts):
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]
        assert rows[i].start == before and rows[i].n_tokens == len(ids)
        assert rows[i].ids_crc32 == zlib.crc32(np.array(ids, "<u4").tobytes())
        before += len(ids)
    shard = shards.read_shard(manifest.orderBy("ids_before").first().path)
    assert shard.doc_id(0) == 0 and shard.document(0).tolist() == [0]
    assert shard.document(4).tolist() == [*tokenizer.encode("a").ids, 0]


def test_starts_of_equal_ids_are_the_same_on_reruns(spark, tmp_path):
    path = public_tokenizers.path("byte_bpe_50k.json")
    frame = documents(spark, [random_text(i, 9) for i in range(80)]).withColumn("doc_id", F.col("doc_id") % 2)
    frame = frame.withColumn("doc_id", F.when(F.col("doc_id") == 1, F.col("doc_id")))
    runs = []
    for name in ("a", "b"):
        manifest = shards.write_shards(
            frame, f"file://{tmp_path}/{name}", lambda: shards.library_encoder(path, PATTERN), shard_ids=40
        )
        runs.append(sorted((r.start, r.n_tokens, r.ids_crc32) for r in shards.read_shards(manifest).collect()))
    assert runs[0] == runs[1] and len(runs[0]) == 80
    assert all(a[0] + a[1] == b[0] for a, b in zip(runs[0], runs[0][1:]))


def test_id_files_of_null_ids_and_no_rows(spark, tmp_path):
    path = public_tokenizers.path("byte_bpe_50k.json")
    frame = documents(spark, ["a b", "c"]).withColumn("doc_id", F.when(F.col("doc_id") == 1, 7))
    for rows, name in ((frame.unionAll(frame), "a"), (frame.limit(0), "b")):
        manifest = shards.write_shards(
            rows, f"file://{tmp_path}/{name}", lambda: shards.library_encoder(path, PATTERN)
        )
        found = sorted((r.doc_id is not None, r.doc_id or 0, r.start, r.doc_id) for r in shards.read_shards(manifest).collect())
        assert [f[3] for f in found] == ([None, None, 7, 7] if name == "a" else [])
    shard = shards.Shard(shards.shard_bytes([None, None, 3, 3, 9], np.array([1, 4, 4, 6, 7]), np.arange(7, dtype="<u2")))
    for run in (1, 2, 3, 50):
        read = [row for part in shard.documents(run) for row in zip(part[0], part[1].tolist(), part[2].tolist())]
        assert read == [(None, 0, 1), (None, 1, 4), (3, 4, 4), (3, 4, 6), (9, 6, 7)]
    data = shards.shard_bytes([1], np.array([2]), np.array([70_000, 1], "<u4"))
    assert shards.Shard(data).ids.tolist() == [70_000, 1]
    with pytest.raises(ValueError):
        shards.Shard(data[:-1] + b"x")


# Mixing


def brute_seats(votes, house):
    seats = [0] * len(votes)
    for _ in range(house):
        best = max(range(len(votes)), key=lambda i: (votes[i] / (2 * seats[i] + 1), -i))
        seats[best] += 1
    return seats


def test_apportionment_by_highest_quotients(spark):
    rng = random.Random(4)
    for house in (0, 1, 7, 100, 977):
        votes = [rng.choice([0, 1, 5, 5, 50, 333.25, 1000]) for _ in range(12)]
        rows = [("g", i, float(v), house) for i, v in enumerate(votes)] + [("h", 0, 3.0, 5), ("h", 1, 3.0, 5)]
        frame = spark.createDataFrame(rows, "g string, i int, votes double, house bigint")
        found = mixing.apportion(frame, "votes", "house", "i", ["g"]).collect()
        assert [r.seats for r in sorted(found, key=lambda r: r.i) if r.g == "g"] == brute_seats(votes, house)
        assert [r.seats for r in sorted(found, key=lambda r: r.i) if r.g == "h"] == [3, 2]


def test_mix_reaches_its_targets(spark):
    texts = [random_text(i, 1 + i * 7 % 300) for i in range(400)] + [None, ""]
    sources = ["big" if i % 3 == 0 else f"s{i % 5}" if i % 11 else None for i in range(402)]
    frame = documents(spark, texts, sources=sources).withColumn("size", F.lit("clash"))
    options = dict(block_words=8, shard_words=2000)
    rows = mixing.mix(frame, **options).collect()
    assert sorted(map(tuple, mixing.mix(frame.repartition(7), **options).collect())) == sorted(map(tuple, rows))
    sizes = Counter()
    for i, text in enumerate(texts):
        sizes[sources[i]] += len(WORD.findall(text or ""))
    names = sorted((n for n in sizes if n is not None)) + [None]
    weights = {name: i % 3 + 1 for i, name in enumerate(names)}
    target, capped = {}, set()
    while True:
        rest = sum(sizes.values()) - sum(3 * sizes[n] for n in capped)
        level = rest / sum(weights[n] for n in names if n not in capped)
        more = {n for n in names if n not in capped and weights[n] * level > 3 * sizes[n]}
        if not more:
            break
        capped |= more
    target = {n: 3 * sizes[n] if n in capped else weights[n] * level for n in names}
    taken, by_id = Counter(), {r.doc_id: r for r in rows}
    for i, text in enumerate(texts):
        row, name = by_id[i], sources[i]
        assert row["size"] == len(WORD.findall(text or "")) and row.source_size == sizes[name]
        assert row.target == pytest.approx(target[name])
        assert 0 <= row.taken <= 3 * row["size"] and 0 <= row.copies <= 3
        taken[name] += row.taken
    for name in names:
        assert abs(taken[name] - target[name]) <= max(0.02 * target[name], 40)
    assert mixing.mix(frame.limit(0)).count() == 0
    assert {r.taken for r in mixing.mix(documents(spark, [None, ""])).collect()} == {0}
    assert mixing.mix(frame.limit(2).unionAll(frame.limit(2))).count() == 4


# Language


def test_language_of_held_out_texts(spark):
    alphabets = {"x": "abcde", "y": "cdefg", "z": "klmno"}
    names = [list(alphabets)[i % 3] for i in range(300)]
    frame = documents(spark, [random_text(i, 30, alphabets[n]) for i, n in enumerate(names)], langs=names)
    bundles = language.learn(frame.where("doc_id % 4 != 2"))
    rows = language.identify(frame, bundles).where("doc_id % 4 = 2").collect()
    assert all(r.lang_pred == r.lang and 0 < r.score <= 1 for r in rows)
    again = language.learn(frame.where("doc_id % 4 != 2").repartition(9))
    assert all((again[n] == bundles[n]).all() for n in bundles)


def test_bundle_is_the_sum_of_bound_vectors():
    space = language.Space(dimensions=64)
    vector = {p: space.letter(p) for p in map(ord, "ab\0")}
    a, b, blank = vector[97], vector[98], vector[0]
    bind = lambda x, y, z: np.roll(x, 2) * np.roll(y, 1) * z
    grams, counts = np.unique(language.ngrams("Ab, ab!"), return_counts=True)
    assert (space.bundle(grams, counts) == 2 * (bind(blank, a, b) + bind(a, b, blank))).all()


def test_language_on_odd_rows(spark):
    frame = documents(spark, ["12 %%", *ODD], langs=[None, *["en"] * len(ODD)]).withColumn("score", F.lit("clash"))
    bundles = language.learn(frame)
    rows = {r.doc_id: r for r in language.identify(frame, bundles).collect()}
    assert {rows[i].lang_pred for i in range(5)} == {"und"} and rows[0].score == 0
    assert rows[10].lang_pred == "en"
    nothing = language.identify(frame, language.learn(frame.limit(0)))
    assert {r.lang_pred for r in nothing.collect()} == {"und"}
    assert language.identify(frame.limit(0), bundles).count() == 0


# Main text

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style><script>var t="</p>";</script></head>
<body><header>Site</header><nav><ul><li><a href=x>One</a><li>Two</ul></nav><!-- c --><div class="ad">Buy</div>
<div class="cookie-notice">We use cookies</div><article><h1>{0}</h1><p><b>{1}<br><p>A &amp; B &eacute;&#233;
 {2}</p></article><aside>Side</aside><section id="comments"><p>Nice!</p></section>
<form>Mail <input></form><footer>&copy; {0}</footer></body></html>"""


def test_main_text_of_template_pages(spark):
    rows = [(i, f"http://u@Host.example:80/{i}?q", PAGE.format(f"Head {i}", "Same line", f"x{i}")) for i in range(6)]
    rows += [(90, "https://alone.example/", PAGE.format("H", "p", "q")), (91, None, None), (92, "no url", ""),
             (93, "http://alone2.example/x", "plain <b>text</b> &lt;tag&gt;"),
             (94, "http://alone3.example/x", "<div>a<p>b<br>c</div><div class='side bar menu'>m</div>d &am"),
             (0, "http://u@Host.example:80/0?q", PAGE.format("Head 0", "Same line", "x0"))]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string").withColumn("text", F.lit(1))
    found = template.extract(pages).collect()
    assert len(found) == len(rows)
    text = {r.page_id: r.text for r in found}
    assert text[3] == "Head 3\nSame line\nA & B éé x3" and text[90] == "H\np\nA & B éé q"
    assert text[91] == text[92] == "" and text[93] == "plain text <tag>" and text[94] == "a\nb\nc\nd &am"
    assert all(r.n_chars == len(r.text) for r in found)
    assert template.extract(pages.limit(0)).count() == 0


def test_template_without_article_drops_what_all_pages_share(spark):
    html = "<html><body><div>Shared words</div><div><p>Own {0}</p><p>More {0}</p></div><div>Same end</div></body></html>"
    rows = [(i, "http://h.example/", html.format(i)) for i in range(10)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    text = {r.page_id: r.text for r in template.extract(pages, least=2).collect()}
    assert text == {i: f"Own {i}\nMore {i}" for i in range(10)}


def extracted(spark, html, n=10, host="h"):
    rows = [(i, f"http://{host}.example/{i}", html.format(i)) for i in range(n)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    return {r.page_id: r.text for r in template.extract(pages).collect()}


def test_repeated_blocks_inside_an_article_go(spark):
    html = ("<html><body><div>Site</div><article><h1>Head {0}</h1><div>Tell your friends</div><p>Own {0}</p>"
            "<p>Kept by all</p><p>More {0}</p><div><a href=x>Buy</a> <a href=y>this</a></div><p>The end of it</p>"
            "</article><div>Legal</div></body></html>")
    expected = "Head {0}\nOwn {0}\nKept by all\nMore {0}"
    assert extracted(spark, html) == {i: expected.format(i) for i in range(10)}
    # Copies of a page have no text of their own, and two pages tell too little.
    assert set(extracted(spark, html.replace("{0}", "x")).values()) == {
        "Head x\nTell your friends\nOwn x\nKept by all\nMore x\nBuy this\nThe end of it"}
    assert "Tell your friends" in extracted(spark, html, 2)[0]


def test_repeated_classes_nest_copy_by_copy():
    tokens = list(enumerate([1, 7, 8, 2, 7, 8, 3]))
    assert template._nested(tokens, {1: 0, 2: 0, 3: 0, 7: 5, 8: 5}) == set(range(7))


def test_classes_that_cross_are_dropped():
    nested = template._nested(list(enumerate([1, 2, 3, 9, 8, 4, 9, 5])), {1: 0, 2: 0, 3: 0, 4: 0, 5: 0, 9: 7, 8: 6})
    assert nested == {0, 1, 2, 5, 7, 4}


@pytest.mark.parametrize("n", [10, 1])
@pytest.mark.parametrize("wrapper", ['class="page has-sidebar"', 'class="no-comments"', 'id="search-page"'])
def test_names_of_wrappers_do_not_leave_out_the_page(spark, wrapper, n):
    inside = '<h1>Head {0}</h1><p>Own words {0}</p><div class="share">Send {0}</div>'
    for main in (inside, f"<article>{inside}</article>"):
        html = f"<html><body><div {wrapper}>{main}</div><div class='sidebar'>Side {{0}}</div></body></html>"
        assert extracted(spark, html, n) == {i: f"Head {i}\nOwn words {i}" for i in range(n)}


def test_heading_in_a_named_element_stays(spark):
    for opened, closed in (('<div class="article-header">', "</div>"), ("<header>", "</header>")):
        html = f"<html><body><article>{opened}<h1>Head {{0}}</h1>{closed}<p>Own {{0}}</p></article></body></html>"
        for n in (10, 1):
            assert extracted(spark, html, n) == {i: f"Head {i}\nOwn {i}" for i in range(n)}


# Quality rules


def brute_counts(text):
    words = WORD.findall(text or "")
    windows = Counter(zip(words, words[1:], words[2:], strict=False))
    covered = {j for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for j in (i, i + 1, i + 2)}
    lines = [line for line in (text or "").split("\n") if WORD.search(line)]
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")),
            len(lines) - len(set(lines)), len(covered))


def test_quality_counts(spark):
    texts = [*ODD, "a b c a b c", "a a a a", "x\ny\nx\n \nx", "# a|b <c> é🙂", "a b c d a b c e a b", random_text(1, 2000, "ab")]
    frame = documents(spark, texts).withColumn("n_words", F.lit("clash"))
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    rows = quality.measure(frame).collect()
    assert {r.doc_id: tuple(r[n] for n in names) for r in rows} == {i: brute_counts(t) for i, t in enumerate(texts)}


def test_binomial_tail_is_exact(spark):
    from math import comb

    cases = [(n, k) for n in (1, 5, 40, 300) for k in (0, 1, 2, 5) if k <= n]
    frame = spark.createDataFrame([(float(n), float(k)) for n, k in cases], "n double, k double")
    for p in (0.005, 0.05, 0.3):
        rows = frame.select("n", "k", quality.binomial_tail(F.col("n"), F.col("k"), p).alias("tail")).collect()
        for r in rows:
            n, k = int(r.n), int(r.k)
            exact = sum(comb(n, i) * p**i * (1 - p) ** (n - i) for i in range(k + 1)) if k < n * p else 1
            assert r.tail == pytest.approx(exact, rel=1e-9)


def test_certified_cutoffs_keep_good_documents(spark):
    """Junk is rejected where labels suffice; the stratum with few labels keeps everything."""
    texts, langs, labels = [], [], []
    for i in range(2600):
        junk = i % 9 == 0
        words = random_text(i, 60).split()
        texts.append(" ".join(w + "###" for w in words) if junk else " ".join(words))
        langs.append("few" if i % 100 == 0 else None if i % 2 else "many")
        labels.append((i, int(not junk)))
    frame = documents(spark, texts, langs=langs)
    marked = spark.createDataFrame(labels, "doc_id bigint, quality int")
    rows = quality.judge(frame, marked, false_rejection=0.1).collect()
    for r in rows:
        assert not r.base_failed
        assert r.kept == (r.doc_id % 9 != 0 or r.stratum == "few")
    none = quality.judge(frame.limit(30), marked.limit(0)).collect()
    assert len(none) == 30 and all(r.kept != r.base_failed for r in none)
    assert quality.judge(frame.limit(0), marked).count() == 0


# Jaccard join


def words_of(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute_components(texts):
    sets = []
    for text in texts:
        words = words_of(text)
        sets.append({tuple(words)} if 0 < len(words) < 5 else set(zip(*(words[i:] for i in range(5)), strict=False)))
    parent = list(range(len(texts)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            common = len(a & sets[j])
            if a and sets[j] and 100 * common >= 80 * (len(a) + len(sets[j]) - common):
                x, y = sorted((root(i), root(j)))
                parent[y] = x
    return [len(s) for s in sets], [root(i) for i in range(len(texts))]


def near_copies(seed, copies, words, edits):
    rng = random.Random(seed)
    base = random_text(seed, words).split()
    for _ in range(copies):
        changed = list(base)
        for _ in range(rng.randint(0, edits)):
            changed[rng.randrange(words)] = f"w{rng.randrange(10**6)}"
        yield " ".join(changed)


def jaccard_texts():
    rng = random.Random(9)
    passage = random_text(77, 60)
    texts = [*ODD[:-1], "a b c", "A B c", "a b c d", "x " * 3000, "x " * 2000]
    texts += [*near_copies(1, 60, 150, 10), *near_copies(2, 40, 40, 4), *near_copies(3, 8, 900, 25)]
    texts += [f"{random_text(i, 12)} {passage} {random_text(i + 500, rng.randint(1, 40))}" for i in range(80)]
    texts += [random_text(i + 3000, rng.randint(1, 120)) for i in range(60)]
    texts += [texts[20]] * 30
    rng.shuffle(texts)
    return texts


@pytest.mark.parametrize("small_blocks", [False, True])
def test_jaccard_components_equal_all_pairs(spark, monkeypatch, small_blocks):
    if small_blocks:
        monkeypatch.setattr(jaccard, "BLOCK_SETS", 5)
    texts = jaccard_texts()
    sizes, roots = brute_components(texts)
    frame = documents(spark, texts).withColumn("n_shingles", F.lit("clash"))
    rows = jaccard.jaccard_components(frame).collect()
    assert len(rows) == len(texts)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in rows} == {
        i: (sizes[i], roots[i]) for i in range(len(texts))}


@pytest.mark.parametrize("small_blocks", [False, True])
def test_jaccard_links_equal_all_pairs(spark, monkeypatch, small_blocks):
    if small_blocks:
        monkeypatch.setattr(jaccard, "BLOCK_SETS", 5)
    texts = jaccard_texts()
    sets = []
    for text in texts:
        words = words_of(text)
        sets.append(frozenset([tuple(words)] if 0 < len(words) < 5 else zip(*(words[i:] for i in range(5)), strict=False)))
    links, pairs, first = Counter(), set(), {s: i for i, s in reversed(list(enumerate(sets)))}
    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            common = len(a & b)
            if a and b and 100 * common >= 80 * (len(a) + len(b) - common):
                links.update((i, j))
                if a != b:
                    pairs.add(tuple(sorted((first[a], first[b]))))
    frame = documents(spark, texts)
    rows = jaccard.jaccard_components(frame, links=True).collect()
    assert {r.doc_id: r.n_links for r in rows} == {i: links[i] for i in range(len(texts))}
    assert [r.component_id for r in sorted(rows)] == brute_components(texts)[1]
    found = [tuple(r) for r in jaccard.jaccard_links(frame).collect()]
    assert len(found) == len(pairs) and set(found) == pairs


def test_jaccard_of_odd_tables(spark):
    frame = documents(spark, [random_text(1, 50)] * 3 + [None])
    assert jaccard.jaccard_components(frame.limit(0)).count() == 0
    rows = jaccard.jaccard_components(frame.unionAll(frame)).collect()
    assert sorted((r.doc_id, r.component_id) for r in rows) == [(i, i if i == 3 else 0) for i in (0, 0, 1, 1, 2, 2, 3, 3)]
    nulls = frame.withColumn("doc_id", F.lit(None).cast("bigint"))
    assert [r.component_id for r in jaccard.jaccard_components(nulls).collect()] == [None] * 4


def test_prefixes_meet_every_linked_set():
    """Whatever l the sets choose, the one with the smaller l meets the other."""
    rng = random.Random(5)
    for _ in range(300):
        n = rng.randint(1, 120)
        one = sorted(rng.sample(range(10**6), n))
        two = sorted({*one[: n - rng.randint(0, n // 9)], *rng.sample(range(10**6), rng.randint(0, n // 9))})
        common = set(one) & set(two)
        if 100 * len(common) < 80 * (len(one) + len(two) - len(common)):
            continue
        cost = {t: rng.choice([2, 3, 50, 4000]) for t in common}
        chosen = []
        for tokens in (one, two):
            sketch = tokens[: int(jaccard._sketch_length(len(tokens), (80, 100)))]
            shared = [(i, t) for i, t in enumerate(sketch) if t in common]
            places = np.array([i for i, _ in shared], np.int64)
            costs = np.array([cost[t] for _, t in shared], np.int64)
            matches, inside, kept = jaccard.choose_prefix(len(tokens), places, costs, (80, 100))
            chosen.append((matches, {shared[i][1] for i in inside}, {shared[i][1] for i in kept}))
        (l1, in1, look1), (l2, in2, look2) = sorted(chosen, key=lambda c: c[0])
        assert look1 & in2


def test_components_of_chains_and_stars(spark):
    chain = [(i, i + 1) for i in range(100, 140)] + [(3, 3), (7, 5), (5, 7), (900, 5)] + [(50, i) for i in range(60, 99)]
    found = components.components(spark.createDataFrame(chain, "node bigint, other bigint"))
    expected = {i: 100 for i in range(101, 141)} | {7: 5, 900: 5} | {i: 50 for i in range(60, 99)}
    assert {r.node: r.component for r in found.collect()} == expected


def test_long_words_and_texts_have_their_shingles(monkeypatch):
    text = " ".join(["word"] * 30 + ["x" * 5000] + random_text(2, 500).split())
    whole = shingles.shingle_set(text)
    shingles._powers.cache_clear()
    monkeypatch.setattr(shingles, "SEGMENT", 1000)
    assert len(shingles.shingle_set(text)) == len(whole)
    shingles._powers.cache_clear()
