"""Word counting: invented documents counted in plain Python, equivalences, plans."""

from __future__ import annotations

from collections import Counter

import pytest
from pyspark.sql import functions as F

from pointtally import operators as O
from pointtally.plans import tables as T
from pointtally.sources import document_lines, document_tokens, read_documents

from conftest import SF

# Six invented documents, one per line, no final newline.
DATASET = "\n".join(
    [
        "the heron waits by the river",
        "river stones  warm slowly",
        "a heron and a stone",
        "slowly the river turns",
        " reeds",
        "stones and reeds and reeds",
    ]
)
WORDS = [w for line in DATASET.split("\n") for w in line.split(" ")]


@pytest.fixture()
def tokens(spark, text_file):
    return document_tokens(document_lines(read_documents(spark, text_file(DATASET))))


def test_dataset_counts(tokens):
    assert tokens.count() == len(WORDS) == 27
    counts = dict((r["word"], r["n"]) for r in O.word_count(tokens).collect())
    assert counts == Counter(WORDS)
    assert counts[""] == 2 and counts["reeds"] == 3
    distinct = set(WORDS)
    assert O.distinct_words(O.word_count(tokens)).first()[0] == len(distinct)
    assert O.avg_word_length(O.word_count(tokens)).first()[0] == sum(map(len, distinct)) // len(distinct)


def test_document_count(spark, text_file):
    docs = read_documents(spark, text_file(DATASET))
    assert O.document_count(docs).first()[0] == 6


def test_partitioned_count_shuffles_words_once(tokens):
    plan = O.word_count_partitioned(tokens)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "RoundRobin" not in plan


@pytest.mark.parametrize("k", [1, 8, 1000])
def test_three_word_counts_agree(tokens, k):
    base = sorted(map(tuple, O.word_count(tokens).collect()))
    assert sorted(map(tuple, O.word_count_salted(tokens, k).collect())) == base
    lines = tokens.groupBy("doc_id", "line_no").agg(F.array_join(F.collect_list("word"), " ").alias("line"))
    salted = document_tokens(O.with_salt(lines, k))
    assert sorted(map(tuple, O.word_count_salted(salted, k).collect())) == base
    assert sorted(map(tuple, O.word_count_partitioned(tokens, k).collect())) == base


def test_three_word_counts_agree_on_table(spark):
    toks = T.tokens(spark, f"{SF}/sf0.001")
    base = O.word_count(toks)
    for other in (O.word_count_salted(toks, 8), O.word_count_partitioned(toks, 8)):
        assert other.exceptAll(base).count() == 0 and base.exceptAll(other).count() == 0


def test_avg_word_length_of_nothing_is_null(spark):
    empty = spark.createDataFrame([], "doc_id bigint, line_no bigint, word string")
    assert O.avg_word_length(O.word_count(empty)).first()[0] is None
