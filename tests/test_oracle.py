import os

import pytest

import __spark_entry__ as entry
import verify

SF = os.environ.get("SPANFORGE_SF", "/root/testdata/sf0.001")
QUICK = [
    "region_gene_summary", "interval_overlap_join", "merged_intervals", "typed_merge", "rank_distance_neighbours", "gene_hit_summary",
    "marker_validation", "longest_prefix_lookup", "token_fingerprint", "class_vote", "confidence_score", "quality_gate", "composition_audit",
    "cluster_numbers", "evidence_coherence", "contract_issues", "vector_nearest",
]
NAMES = list(entry.queries()) if os.environ.get("SPANFORGE_FULL") else QUICK

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="tables are not here")


@pytest.fixture(scope="module")
def con():
    return verify.connect(SF)


@pytest.mark.parametrize("name", NAMES)
def test_query_equals_sql(spark, con, name):
    result, _, _ = verify.compare(spark, con, SF, name)
    assert result.startswith(("ok", "rows-only")), result


def test_every_check_has_its_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() > 0
