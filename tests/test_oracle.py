"""Every registered query of the library against its SQL twin."""

import os
import subprocess
import sys

import oracle
import pytest

from helixframe.plans import ORACLE_SQL, QUERIES

SF = "/root/testdata/sf0.001"
#: Only at this size do the derived tables have rows that tie in all but their counts.
TIES, LARGER = ("mutect_filter", "somatic_vcf_filter", "varscan_filter", "snp_indel_override", "caller_consensus"), "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, name):
    n, mine, theirs = oracle.differences(spark, SF, QUERIES[name], ORACLE_SQL[name])
    assert not mine and not theirs, (mine, theirs)
    assert n > 0


@pytest.mark.parametrize("name", TIES)
def test_ties_equal_sql(spark, name):
    n, mine, theirs = oracle.differences(spark, LARGER, QUERIES[name], ORACLE_SQL[name])
    assert n > 0 and not mine and not theirs, (mine, theirs)


@pytest.fixture(scope="module")
def letterless(spark, tmp_path_factory):
    """The smallest tables, with documents without a letter, without a text and with too short a one."""
    folder = tmp_path_factory.mktemp("odd")
    for table in oracle.TABLES:
        if table != "documents":
            os.symlink(f"{SF}/{table}.parquet", folder / f"{table}.parquet")
    odd = "SELECT * FROM VALUES (5000L, ''), (5001L, '12 34 --'), (5002L, NULL), (5003L, 'ab, cd'), (5004L, 'éß'), (5005L, 'abcdefghijkl') AS t(doc_id, text)"
    given = spark.read.parquet(f"{SF}/documents.parquet")
    given.unionByName(spark.sql(odd), allowMissingColumns=True).coalesce(1).write.parquet(str(folder / "documents"))
    os.symlink(next((folder / "documents").glob("*.parquet")), folder / "documents.parquet")
    return str(folder)


@pytest.mark.parametrize("name", ["epitope_report", "neoepitopes"])
def test_texts_without_letters_equal_sql(spark, letterless, name):
    """A remainder by their length of 0 must not be worked out."""
    n, mine, theirs = oracle.differences(spark, letterless, QUERIES[name], ORACLE_SQL[name])
    assert n > 0 and not mine and not theirs, (mine, theirs)


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


@pytest.mark.parametrize("missing, found", [("helixframe.llm", "absent"), ("corpus_pipeline", "absent"), ("numpy.no_such_part", "raised")])
def test_only_an_absent_subpackage_is_passed_over(missing, found):
    """In a process of its own: importing the entry where one module can't be found."""
    code = f"""
import sys
class Gone:
    def find_spec(self, name, path=None, target=None):
        if name == {missing!r} or (name == "helixframe.llm" and {missing!r}.startswith("numpy")):
            raise ModuleNotFoundError("no module " + {missing!r}, name={missing!r})
sys.meta_path.insert(0, Gone())
try:
    import __spark_entry__ as entry
except ModuleNotFoundError:
    print("raised")
else:
    print("absent" if not any(q.startswith("op") for q in entry.queries()) and len(entry.queries()) > 60 else "present")
"""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    assert subprocess.run([sys.executable, "-c", code], cwd=root, capture_output=True, text=True, timeout=120).stdout.split() == [found]
