"""Every query of the library against its SQL, at the smallest scale; those that sum and cut numbers also at the next."""

import pytest
from conftest import duck, same_rows

from readloom.plans import ORACLE_SQL, QUERIES


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, sf_dir, name):
    assert same_rows(QUERIES[name](spark, sf_dir).toPandas(), duck(sf_dir).sql(ORACLE_SQL[name]).df())


@pytest.mark.parametrize("name", ["annotated_gene_lines", "annotated_transcript_lines", "annotated_exon_lines", "gene_from_transcripts", "exon_from_transcripts"])
def test_exact_sums(spark, name):
    sf_dir = "/root/testdata/sf0.01"
    assert same_rows(QUERIES[name](spark, sf_dir).toPandas(), duck(sf_dir).sql(ORACLE_SQL[name]).df())
