"""Periodic runs against a plain walk over every period."""
import hashlib
import random
import re
import zlib
from fractions import Fraction

import numpy as np
import pytest

from seamline.llm import word_runs


def plain_runs(words, least=24, power=3):
    ends = {}
    for p in range(1, len(words) // power + 1):
        i = 0
        while i + p < len(words):
            j = i
            while j + p < len(words) and words[j] == words[j + p]:
                j += 1
            if j > i and j + p - i >= max(least, power * p):
                ends.setdefault((i, j + p - i), p)  # periods ascend
            i = max(j, i + 1)
    return sorted(((s, n, p) for (s, n), p in ends.items()), key=lambda r: (r[0], r[2]))


def made_texts(rng, texts):
    out = []
    for _ in range(texts):
        size, letters = rng.choice([0, 1, 23, 24, 60, 200, 700]), rng.choice([1, 2, 3, 50])
        words = [rng.randrange(letters) for _ in range(size)]
        for _ in range(rng.randint(0, 4)):
            a, p = rng.randrange(size or 1), rng.randint(1, 60)
            for i in range(a + p, min(size, a + p * rng.randint(2, 9))):
                words[i] = words[i - p]
        out.append(words)
    return out


@pytest.mark.parametrize("least, power", [(24, 3), (6, 2), (40, 5)])
@pytest.mark.parametrize("seed", range(12))
def test_runs_of_a_batch(seed, least, power):
    texts = made_texts(random.Random(seed), 6)
    first = np.cumsum([0, *map(len, texts)])
    got = word_runs.find_runs(np.array([w for t in texts for w in t], np.int64), first, least, power)
    assert [tuple(r) for r in got.tolist()] == [(k, *r) for k, t in enumerate(texts) for r in plain_runs(t, least, power)]


def test_small_grid_blocks(monkeypatch):
    texts = made_texts(random.Random(99), 8)
    first, words = np.cumsum([0, *map(len, texts)]), np.array([w for t in texts for w in t], np.int64)
    whole = word_runs.find_runs(words, first)
    monkeypatch.setattr(word_runs, "GRID_POINTS", 7)
    assert len(whole) and (word_runs.find_runs(words, first) == whole).all()


def test_every_pair_of_residues_meets_in_the_cover():
    a, b = np.meshgrid(np.arange(word_runs.COVER), np.arange(word_runs.COVER), indexing="ij")
    for side in (a, b):
        assert np.isin((side + word_runs.MEETING) % word_runs.COVER, word_runs.MEMBERS).all()


def test_common_extensions():
    rng = random.Random(5)
    words = [rng.randrange(2) for _ in range(300)]
    words[150:] = words[:150]  # long common extensions
    line = np.array(words + [-1 - k for k in range(word_runs.COVER)], np.int64)
    i, j = np.array([(a, b) for a in range(0, 300, 3) for b in range(1, 300, 2) if a != b]).T
    want = [next(k for k in range(400) if line[a + k] != line[b + k]) for a, b in zip(i, j)]
    assert word_runs.CommonExtension(line).between(i, j).tolist() == want


def described(doc_id, text, rearrange):
    words = re.findall("[^\x20\x09-\x0D]+", text or "")
    n, h = len(words), zlib.crc32(str(doc_id).encode())
    if rearrange and doc_id is not None and h % 10 == 0 and n:
        g = h // 10
        a, p = g % n, 1 + (n - g % n) // (3 + g % 8)
        words = [words[a + (i - a) % p] if i >= a else words[i] for i in range(n)]
    runs = plain_runs(words)
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=(None, None, None))
    kept = [w for i, w in enumerate(words) if not any(s + p <= i < s + m for s, m, p in runs)]
    return (doc_id, n, len(runs), *best, runs, hashlib.sha256(" ".join(kept).encode()).hexdigest())


@pytest.mark.parametrize("rearrange", [False, True])
def test_described_texts(spark, rearrange):
    rng = random.Random(3)
    texts = [" ".join(f"w{x}" for x in t) for t in made_texts(rng, 60)]
    texts += [None, "", " \n\t", "é " * 40 + "x", "a\x0bb\x0c" * 30, "No no NO " * 20, "word-longer-than-fifteen-bytes ü " * 9, "tail " + "q r " * 3000]
    rows = [(None if k == 7 else k, t, "x", 1) for k, t in enumerate(texts)]
    docs = spark.createDataFrame(rows + rows[10:12], "doc_id long, text string, runs string, n_words int").repartition(3)
    got = [(r.doc_id, r.n_words, r.n_runs, r.start, r.length, r.period, [tuple(x) for x in r.runs], r.collapsed_sha256)
           for r in word_runs.word_runs(docs, rearrange=rearrange).collect()]
    want = [described(d, t, rearrange) for d, t, *_ in rows + rows[10:12]]
    key = lambda r: tuple(str(x) for x in r)
    assert sorted(got, key=key) == sorted(want, key=key)
    assert word_runs.word_runs(docs.limit(0)).count() == 0


def test_query_digest(spark, tmp_path):
    rows = [(k, "a b c d e f " * (k + 3) + "end") for k in range(30)] + [(30, None)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    for r in word_runs.op13_word_runs(spark, str(tmp_path)).collect():
        _, _, n, start, length, period, runs, kept = described(r.doc_id, dict(rows)[r.doc_id], True)
        digest = hashlib.sha256("".join(f"{s},{m},{p}\n" for s, m, p in runs).encode()).hexdigest()
        milli = None if start is None else 1000 * length // period
        assert tuple(r)[1:] == (n, start, length, period, milli, digest, kept)
