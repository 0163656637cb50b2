import os
from dataclasses import replace

import pytest

from tests.conftest import rows
from weft.config import LinkConfig
from weft.operators import blocking, postings
from weft.plans import queries as plans
from weft.session import cut


@pytest.mark.parametrize("config", [LinkConfig(), LinkConfig(max_pair_frequency=1, blank_country=True), LinkConfig(max_pair_frequency=None)])
def test_postings_give_what_the_index_gives(spark, small, config):
    queries, targets = plans._written(spark, small)
    again = cut(queries.orderBy("entity_id", "name_norm").limit(5).withColumn("address_tokens", postings.F.col("name_tokens")))  # ids with two records
    queries, targets = queries.unionByName(again), targets.unionByName(again.withColumn("target_source", postings.F.lit(2)))
    hot = blocking.hot_pairs(targets, config)
    index = blocking.weighted_index(targets, config, hot)
    found = postings.retrieve_raw(queries, targets, config)
    assert rows(found) == rows(blocking.raw_candidates(blocking.query_signatures(queries, hot, config), index))
    assert found.count() > 0


def test_pairs_that_no_query_has_are_not_exchanged(spark, small):
    queries, targets = plans._written(spark, small)
    config = replace(LinkConfig(), longest_tokens=6)
    asked, held = (postings.hashed_words(r, config.longest_tokens) for r in (cut(queries.limit(10)), targets))
    known = spark.sparkContext.broadcast(postings._known(postings.keys_of(asked, 2)))
    every, passed = postings.keys_of(held, 2), postings.keys_of(held, 2, known)
    shared = postings.keys_of(asked, 2).select("key").distinct()
    assert rows(passed.join(shared, "key", "left_semi")) == rows(every.join(shared, "key", "left_semi"))
    assert passed.count() < every.count() / 10


def test_words_that_no_query_has_are_not_exchanged(spark, small):
    """counts and weights of the words that queries have stay as they are."""
    queries, targets = plans._written(spark, small)
    asked = postings._single_keys(cut(queries.limit(10)))
    every, passed = (postings._rare_singles(targets, LinkConfig(), spark.sparkContext.broadcast(postings._known(k))) for k in (postings._single_keys(targets), asked))
    shared = asked.select("key").distinct()
    assert rows(passed.join(shared, "key", "left_semi")) == rows(every.join(shared, "key", "left_semi"))
    assert passed.count() < every.count() / 5


def test_no_posting_is_broadcast(spark, small, capsys):
    """what is written compressed is larger in memory; only the counts of countries may be broadcast."""
    queries, targets = plans._written(spark, small)
    blocking.retrieve(queries, targets).explain("simple")
    assert capsys.readouterr().out.count("BroadcastHashJoin") <= 1


@pytest.mark.parametrize("name", ["candidate_lists", "candidate_topk", "blocking_recall_stages", "macro_f05"])
def test_no_records_candidates_or_labels_are_broadcast(spark, small, capsys, name):
    """F6, F7, F8, F11: of each index that a plan reads only the counts of countries may be broadcast, though all tables are small here."""
    plans.queries()[name](spark, small).explain("simple")
    assert capsys.readouterr().out.count("BroadcastExchange") <= (name.startswith("candidate"))


def test_labelled_records_alone_are_prepared(spark, small):
    """a query of labelled records normalises no others."""
    every, _ = plans._written(spark, small)
    some, _ = plans._written(spark, small, labelled=True)
    assert rows(some) == rows(plans._labelled_queries(every, spark, small))
    assert 0 < some.count() < every.count()


@pytest.mark.parametrize("name", ["candidate_lists", "candidate_topk", "pair_features", "blocking_stats", "match_lists"])
def test_candidates_are_made_chunk_by_chunk(spark, small, monkeypatch, name):
    """F3-F7: the results are the same however queries are cut, and of a query's own tables the results alone stay on disk."""
    kept, real = [], postings.cut
    whole = rows(plans.queries()[name](spark, small))
    monkeypatch.setattr(postings, "LEAST", 20)
    monkeypatch.setattr(postings, "CHUNKS", 1 << 20)

    def cut_(df, keep=0):
        made = real(df, keep)
        kept.append(made.inputFiles()[0].removeprefix("file:").rpartition("/")[0])
        return made

    monkeypatch.setattr(postings, "cut", cut_)
    assert rows(plans.queries()[name](spark, small)) == whole
    left = sum(os.path.exists(path) for path in kept)
    assert len(kept) > 20 and left <= len(kept) / 2
