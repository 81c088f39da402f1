import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMOKE = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from seamline.session import local_session

    s = local_session(cores=4, shuffle_partitions=4, app="seamline-tests")
    yield s
    s.stop()


@pytest.fixture
def chunk(spark):
    """Set the scan chunk size for one test (small chunks exercise halo and carry)."""
    def set_chunk(n):
        spark.conf.set("seamline.scan.chunkLines", str(n))
    yield set_chunk
    spark.conf.unset("seamline.scan.chunkLines")


def make_lines(spark, docs):
    """docs: {doc_id: text} -> lines DataFrame via the production splitter."""
    from seamline.sources.corpus import lines_from_text

    df = spark.createDataFrame([(k, v) for k, v in docs.items()], "doc_id long, text string")
    return lines_from_text(df)
