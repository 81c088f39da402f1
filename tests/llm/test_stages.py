"""The pipeline's filtering stages on frames with clashing columns, null languages and empty tables."""
import public_tokenizers
import pytest

from seamline.llm import bbit_minhash, block_names, secret_scan, segment_langid
from seamline.llm.common import Scratch

ODD = ["__uid", "__cuts", "__live", "__lang", "__text", "__score", "uid", "cuts", "live", "node", "comp", "name", "level", "block", "score", "owner", "repo", "n"]
VOCAB = public_tokenizers.path("piece_bpe_32k.model")
STAGES = [lambda d: segment_langid.drop_unidentified(d, VOCAB), block_names.drop_exact_copies, bbit_minhash.drop_near_copies, secret_scan.redact_live]
LONG = " ".join(f"word{k} is here" for k in range(40))
ROWS = [(0, LONG, "en", "a"), (1, LONG, "en", "b"), (2, LONG + " more", "en", "a"), (3, None, "en", "a"), (4, "", None, None), (5, "12 34", "en", "a"),
        (6, "der Hund und die Katze und das Haus", "de", "a"), (7, "the dog and the cat and the house", "en", "a"), (8, "der Baum und die Katze", None, "b"),
        (9, "my token=Zx81kQpLm20aTr here", "en", "a"), (None, "another text", "en", "a")]
KEPT = [{0, 1, 2, 6, 7, 8, 9, None}, {1, 2, 4, 5, 6, 7, 8, 9, None}, {0, 3, 4, 5, 6, 7, 8, 9, None}, {*range(10), None}]


@pytest.mark.parametrize("stage, kept", list(zip(STAGES, KEPT)))
def test_stage_keeps_every_column(spark, stage, kept):
    schema = "doc_id long, text string, lang string, source string, " + ", ".join(f"{c} string" for c in ODD)
    rows = [(*r, *[f"{c}-{r[0]}" for c in ODD]) for r in ROWS]
    docs = Scratch(spark, "t").keep(spark.createDataFrame(rows, schema).repartition(2), "docs")
    got = stage(docs)
    assert got.schema.names == docs.schema.names
    found = got.collect()
    assert {r.doc_id for r in found} == kept and len(found) == len(kept)
    for r in found:
        assert [r[c] for c in ODD] == [f"{c}-{r.doc_id}" for c in ODD]
    assert stage(docs.filter("doc_id < -1")).count() == 0


def test_null_languages_are_filled(spark):
    rows = [(100 * g + k, t, lang, "s") for g, (lang, t) in enumerate([("de", ROWS[6][1]), ("en", ROWS[7][1])]) for k in range(9)]
    docs = spark.createDataFrame(rows + [(900, ROWS[8][1], None, "s"), (901, "the cat", None, "s")], "doc_id long, text string, lang string, source string")
    got = {r.doc_id: r.lang for r in segment_langid.drop_unidentified(docs, VOCAB).collect()}
    assert (got[900], got[901]) == ("de", "en") and got[0] == "de" and got[100] == "en"
