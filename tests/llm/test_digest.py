"""The quartile digest against a loop over bytes, and its likeness against a loop over buckets."""

import hashlib
import math
import random

from pyspark.sql import functions as F

from doselens.llm import digest

PAIRS = [(1, 2), (1, 3), (2, 3), (1, 4), (2, 4), (3, 4)]


def bucket(salt, last, near, far):
    mixed = 0
    for i, byte in enumerate((last, near, far)):
        mixed += byte * ((2 * (3 * salt + i) + 1) * 0x9E3779B1 % 2**32)
    mixed %= 2**32
    mixed ^= mixed >> 15
    return (mixed * 0x85EBCA6B) % 2**32 >> 24


def brute(text):
    """Length code, two spreads and the quartile of each bucket."""
    data = text.encode()
    counts = [0] * 256
    for i in range(len(data)):
        for salt, (near, far) in enumerate(PAIRS):
            if i >= far:
                counts[bucket(salt, data[i], data[i - near], data[i - far])] += 1
    if not any(counts):
        return (0, 0, 0, [0] * 256)
    ordered = sorted(counts)
    low, middle, high = ordered[63], ordered[127], ordered[191]
    quartiles = [sum(c > mark for mark in (low, middle, high)) for c in counts]
    top = max(high, 1)
    length = 1 + min(254, round(4 * math.log2(len(data) + 1)))
    return (length, min(255, 64 * low // top), min(255, 64 * middle // top), quartiles)


def read(fingerprint):
    data = bytes.fromhex(fingerprint)
    return (*data[:3], [byte >> shift & 3 for byte in data[3:] for shift in (0, 2, 4, 6)])


def brute_likeness(one, other):
    if one == other:
        return 1.0
    if not (one[0] and other[0]):
        return 0.0
    total = 6 * max(0, abs(one[0] - other[0]) - 1)
    total += sum(4 * max(0, abs(one[i] - other[i]) // 4 - 1) for i in (1, 2))
    for a, b in zip(one[3], other[3], strict=True):
        total += 6 if abs(a - b) == 3 else abs(a - b)
    return 1 - min(512, total) / 512


def sample(seed, n):
    rng = random.Random(seed)
    return "".join(rng.choices("the quick brown fox é漢🙂\n", k=n))


TEXTS = [None, "", "a", "ab", "abc", "aaaaaaaaaa", "é", "漢字", sample(1, 50), sample(2, 400), sample(2, 401), sample(3, 3000), sample(3, 3000)]


def test_digests_and_likeness_equal_brute_force(spark):
    rows = [(i * 3, t) for i, t in enumerate(TEXTS)]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3).withColumn("fingerprint", F.lit("clash"))
    found = {r.doc_id // 3: r for r in digest.compare_neighbours(frame).collect()}
    assert len(found) == len(TEXTS)
    for i, text in enumerate(t or "" for t in TEXTS):
        following = TEXTS[(i + 1) % len(TEXTS)] or ""
        quarter = len(text) // 4
        edited = text[: len(text) - quarter] + following[:quarter]
        own, changed, next_own = brute(text), brute(edited), brute(following)
        row = found[i]
        assert read(row.fingerprint) == own and read(row.edited_fingerprint) == changed
        assert row.n_chars == len(text) and row.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert math.isclose(row.near_edited, brute_likeness(own, changed))
        assert math.isclose(row.near_next, brute_likeness(own, next_own))


def test_texts_without_triplets_are_like_the_empty_one():
    """One and two bytes hold no triplet; three hold one."""
    assert digest.fingerprint("a") == digest.fingerprint("ab") == digest.fingerprint("") == digest.EMPTY
    assert digest.fingerprint("abc") != digest.EMPTY
    assert digest.likeness(digest.fingerprint("a"), digest.fingerprint("abc")) == 0


def test_parts_of_a_long_text_make_its_digest(monkeypatch):
    text = sample(5, 5000)
    whole = digest.fingerprint(text)
    monkeypatch.setattr(digest, "CHUNK", 7)
    assert digest.fingerprint(text) == whole and read(whole) == brute(text)
