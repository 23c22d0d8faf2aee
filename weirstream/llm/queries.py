"""Queries of the corpus problems, and the SQL that checks those SQL can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from weirstream.llm.encode import encode
from weirstream.llm.mixing import mix, shares
from weirstream.llm.residue import residue_rows
from weirstream.sources.tables import table

QUERIES = {}
SQL = {}


def query(name: str, sql: str | None = None):
    def keep(f):
        QUERIES[name] = f
        if sql:
            SQL[name] = sql
        return f

    return keep


@query("p9_found")
def p9_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return residue_rows(table(spark, sf_dir, "documents")).select("doc_id")


@query("p9_kinds")
def p9_kinds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same documents with the kinds of remains found in each."""
    return residue_rows(table(spark, sf_dir, "documents"))


@query("p7_ids")
def p7_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode(table(spark, sf_dir, "documents"))


@query("p8_mix")
def p8_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The chosen documents and how often each is taken."""
    return mix(table(spark, sf_dir, "documents"), table(spark, sf_dir, "mix_targets"))


@query("p8_shares")
def p8_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Target and actual share of all tokens by source."""
    return shares(p8_mix(spark, sf_dir), table(spark, sf_dir, "mix_targets"))
