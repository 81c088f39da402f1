"""The set similarity join against all pairs of plain Python sets."""
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from seamline.llm import bit_filter, set_skip_join
from seamline.llm.common import Scratch

TEXTS = [None, "", " \n", "one", "One", "one two", "a b c", "A B C", "a  b\tc", "a b c d", "x " * 50, "x " * 90, "tail é ü 日本語 ok", "w" * 40 + " v u"]


def plain_set(text, words):
    found = (text or "").encode().translate(bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")).split()
    if not found:
        return set()
    return {tuple(found[k:k + words]) for k in range(len(found) - words + 1)} or {tuple(found)}


def plain_groups(rows, words, percent):
    sets = [plain_set(t, words) for _, t in rows]
    up = list(range(len(rows)))

    def find(x):
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and min(map(len, (sets[i], sets[j]))) * 100 >= percent * max(map(len, (sets[i], sets[j]))):
                both = len(sets[i] & sets[j])
                if 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                    up[find(i)] = find(j)
    least = {}
    for k, (d, _) in enumerate(rows):
        least[find(k)] = min(d, least.get(find(k), d))
    return Counter((d, len(sets[k]), least[find(k)]) for k, (d, _) in enumerate(rows))


def made(seed, letters, count):
    """Chains of changed copies of some texts, around every similarity."""
    rng = random.Random(seed)
    word = lambda: f"w{rng.randrange(letters)}"
    texts, bases = [], [[word() for _ in range(rng.choice([4, 30, 120, 400]))] for _ in range(6)]
    common = [word() for _ in range(60)]
    for _ in range(count):
        text = list(rng.choice(bases))
        for _ in range(rng.choice([0, 1, 1, 2, 3, 6])):
            at = rng.randrange(len(text))
            text[at:at + rng.choice([0, 1])] = [word()]
        if rng.random() < 0.2:
            text += common
        texts.append(" ".join(text))
        if rng.random() < 0.3:
            bases.append(text)
    return texts


@pytest.mark.parametrize("seed, letters, words, percent, members", [(1, 5000, 3, 90, 256), (2, 40, 3, 90, 3), (3, 5000, 2, 80, 5), (4, 8, 1, 60, 256)])
def test_components(spark, monkeypatch, seed, letters, words, percent, members):
    monkeypatch.setattr(set_skip_join, "SLOT_BITS", 18)
    monkeypatch.setattr(set_skip_join, "MEMBERS", members)
    rows = [(1000 - k, t) for k, t in enumerate(TEXTS + made(seed, letters, 260))]
    rows += [(rows[20][0], rows[40][1]), (2000, rows[50][1])]
    docs = Scratch(spark, "t").keep(spark.createDataFrame([(*r, "x", 7) for r in rows], "doc_id long, text string, unit string, n int").repartition(3), "docs")
    got = Counter(tuple(r) for r in set_skip_join.similar_groups(docs, words, percent).collect())
    assert got == plain_groups(rows, words, percent)


def test_null_ids_and_empty_tables(spark):
    docs = spark.createDataFrame([(None, "a b c d"), (5, "a b c d"), (None, "q"), (7, None)], "doc_id long, text string")
    got = sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in set_skip_join.similar_groups(docs).collect())
    assert got == sorted([("None", 2, "5"), ("5", 2, "5"), ("None", 1, "None"), ("7", 0, "7")])
    assert set_skip_join.similar_groups(docs.filter("doc_id < 0")).count() == 0


def _sets(seed, universe):
    rng = np.random.default_rng(seed)
    base = rng.integers(0, 1 << 63, universe, dtype=np.uint64)
    sets = []
    for _ in range(40):
        keep = base[rng.random(universe) < rng.choice([0.9, 0.97, 1.0])]
        sets.append(np.unique(np.concatenate([keep, rng.integers(0, 1 << 63, rng.integers(0, 1 + universe // 20), dtype=np.uint64)])))
    return sets


@pytest.mark.parametrize("universe", [30, 1000, 1100, 5000])
def test_no_linked_pair_is_skipped(universe):
    sets = _sets(universe, universe)
    raw = set_skip_join.bitmaps(np.concatenate(sets), np.concatenate([[0], np.cumsum([len(s) for s in sets])]))
    order = sorted(range(len(sets)), key=lambda k: len(sets[k]))
    sets, raw = [sets[k] for k in order], [raw[k] for k in order]
    n = np.array([len(s) for s in sets] * 2)
    side = np.repeat([0, 1], len(sets))
    bits = set_skip_join._Bitmaps(pa.array(raw * 2, pa.binary()))
    found = set()
    for i, j, off in set_skip_join.surviving(n, np.zeros(len(n), np.int64), np.tile(np.arange(len(sets)), 2), side, np.zeros(len(n), np.int64), np.zeros(len(n), bool), bits, 90):
        for x, y, d in zip(i.tolist(), (j - len(sets)).tolist(), off.tolist()):
            assert d <= len(np.setxor1d(sets[x], sets[y]))
            found.add((x, y))
    for x in range(len(sets)):
        for y in range(len(sets)):
            both = len(np.intersect1d(sets[x], sets[y]))
            if x != y and 100 * both >= 90 * (len(sets[x]) + len(sets[y]) - both):
                assert (x, y) in found


@pytest.mark.parametrize("bits", [10, 20])
def test_bit_filter(spark, bits):
    held = np.arange(0, 3000, 7) * 10**15
    marks = bit_filter.bits_of(spark.createDataFrame([(int(x),) for x in held], "x long").repartition(3), bits).value
    assert bit_filter.may_hold(marks, held).all() and len(marks) == 1 << bits - 3
    assert bits < 20 or bit_filter.may_hold(marks, held + 1).sum() < 10


@pytest.mark.parametrize("percent", [60, 80, 90, 100])
def test_prefixes_and_overlaps(percent):
    for x in range(1, 60):
        for y in range(1, 60):
            need = min(k for k in range(0, 200) if 100 * k >= percent * (x + y - k))
            assert set_skip_join.needed(x + y, percent) == need
            if need <= min(x, y):  # linked sets share an element of both prefixes
                assert x - set_skip_join.prefix_size(x, percent) + 1 <= need
