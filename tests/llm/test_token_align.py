"""Token alignment against the tokenizers on whole texts and plain Python sets."""
import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest

from seamline.llm import token_align

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
TEXTS = [
    None, "", " ", "a", "One two, three.", "  two  spaces\n\n end ", "x" * 300, "éàü ß 日本語 😀 ok", "▁ mark", "<s> <|endoftext|> </s>", "nul \x00 byte",
    "12345678 90", "tab\tand\r\nline", " the", "the", "antidisestablishmentarianism 123,456.78 foo_bar(baz)", "ﬁ ligature ½", " nbsp　wide",
    "0123456789abcdef" * 20, "word " * 300, "Ὀδυσσεύς Россия العربية", "á é",
]


@pytest.fixture(scope="module")
def encoders():
    import sentencepiece
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(A)
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=B), token_align.byte_level_bytes(A)


def plain(encoders, text):
    """Groups of (A ids, B ids)."""
    a, b, known = encoders
    if not text:
        return []
    a_ids, b_ids = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
    a_bytes = [known.joined(np.array([i])).tobytes() for i in a_ids]
    b_bytes = [bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode() for i, p in ((i, b.id_to_piece(i)) for i in b_ids)]
    want = (" " + text).encode()
    if b"".join(a_bytes) != want or b"".join(b_bytes) != want:
        return []
    ends = [np.cumsum([len(x) for x in side]).tolist() for side in (a_bytes, b_bytes)]
    groups, at = [], [0, 0]
    for end in sorted(set(ends[0]) & set(ends[1])):
        to = [side.index(end) + 1 for side in ends]
        groups.append((a_ids[at[0]:to[0]], b_ids[at[1]:to[1]]))
        at = to
    return groups


def described(docs, encoders):
    grouped = [(d, plain(encoders, t)) for d, t in docs]
    held = Counter(p for _, groups in grouped for p in {(a, b) for x, y in groups for a in x for b in y})
    best = {}
    for (a, _), n in held.items():
        best[a] = max(n, best.get(a, 0))
    for d, groups in grouped:
        links = [(a, b) for x, y in groups for a in x for b in y]
        said = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        yield (d, sum(len(x) for x, _ in groups), sum(len(y) for _, y in groups), len(groups), len(links),
               sum(held[p] == best[p[0]] for p in links), sum(held[p] for p in links), hashlib.sha256(said.encode()).hexdigest() if said else "")


def key(row):
    return tuple(str(x) for x in row)


@pytest.mark.parametrize("block_docs", [4096, 3])
def test_counts(spark, encoders, monkeypatch, block_docs):
    monkeypatch.setattr(token_align, "BLOCK_DOCS", block_docs)
    rows = [(None if k == 4 else k, t, 5, "p") for k, t in enumerate(TEXTS)]
    rows += rows[14:17] + [(100 + k, f"value {k} of café №{k}", 5, "p") for k in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, block int, pairs string").repartition(3)
    got = [tuple(r) for r in token_align.alignment_counts(docs, A, B).collect()]
    assert sorted(got, key=key) == sorted(described([r[:2] for r in rows], encoders), key=key)


def test_whole_alignments(spark, encoders):
    docs = spark.createDataFrame([(k, t) for k, t in enumerate(TEXTS)], "doc_id long, text string")
    for r in token_align.align_tokens(docs, A, B).collect():
        at, groups = (0, 0), []
        for to in zip(r.a_ends, r.b_ends):
            groups.append((r.a_ids[at[0]:to[0]], r.b_ids[at[1]:to[1]]))
            at = to
        assert groups == plain(encoders, TEXTS[r.doc_id])
        assert (len(r.a_ids), len(r.b_ids)) == at
        assert sorted(set(r.link_a)) == list(range(at[0])) and sorted(set(r.link_b)) == list(range(at[1]))


def test_empty_table(spark):
    assert token_align.alignment_counts(spark.createDataFrame([], "doc_id long, text string"), A, B).count() == 0


@pytest.mark.parametrize("lane", [1, 2, 5, 1000])
def test_lanes_and_wide_groups(lane, monkeypatch):
    monkeypatch.setattr(token_align, "WIDE", 6)
    rng = random.Random(lane)
    for _ in range(60):
        ends, firsts, ids = ([], []), ([0], [0]), ([], [])
        base = 0
        for _ in range(rng.randint(1, 4)):
            size = rng.choice([0, 1, 5, 40])
            for k in range(2):
                inner = sorted(rng.sample(range(1, size), rng.randint(0, size - 1))) if size > 1 else []
                own = [base + x for x in inner + [size]] if size else []
                ends[k].extend(own)
                ids[k].extend(rng.randrange(4) for _ in own)
                firsts[k].append(len(ends[k]))
            base += size
        a, b = (np.array(x, np.int64) for x in ids)
        link_a, link_b, cut = token_align.lockstep(*(np.array(x, np.int64) for x in (*ends, *firsts)), lane)
        common = sorted(set(ends[0]) & set(ends[1]))
        a_to, b_to = (np.searchsorted(np.array(e, np.int64), common, side="right") for e in ends)
        assert (link_a[cut] + 1).tolist() == a_to.tolist() and (link_b[cut] + 1).tolist() == b_to.tolist()
        a_from, b_from = (np.concatenate([[0], x])[:-1].astype(np.int64) for x in (a_to, b_to))
        of, pair, times = token_align.group_links(a, b, link_a, link_b, a_from, b_from, a_to, b_to)
        got = Counter()
        for g, p, n in zip(of.tolist(), pair.tolist(), times.tolist()):
            got[g, p] += n
        want = Counter((g, int(x) << 16 | int(y)) for g in range(len(common))
                       for x in a[a_from[g]:a_to[g]] for y in b[b_from[g]:b_to[g]])
        assert got == want


def test_blocks_hold_all_rows():
    batch = pa.RecordBatch.from_arrays([pa.array(range(50)), pa.array(["x" * (k * 40_000) for k in range(50)])], ["doc_id", "text"])
    assert [x for b in token_align._blocks(batch) for x in b.column(0).to_pylist()] == list(range(50))
