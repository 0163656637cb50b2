"""Blocking signatures of normalised records: exact words, typing shapes, and pairs of the longest words."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weft.config import ADDRESS_STOP, NAME_STOP, LinkConfig


def _words(tokens: str, stop: list[str], kind: str) -> Column:
    kept = F.filter(F.col(tokens), lambda t: (F.length(t) >= 3) & ~t.isin(stop))
    return F.transform(kept, lambda t: F.struct(F.lit(kind).alias("kind"), t.alias("token")))


def _keys(records: DataFrame) -> list[str]:
    """What a signature is known by: the record, its country, and its source where there is one."""
    return [*(["target_source"] if "target_source" in records.columns else []), "entity_id", "country"]


def _with_words(records: DataFrame, others: list[str] | None = None) -> DataFrame:
    words = F.concat(_words("name_tokens", NAME_STOP, "ne"), _words("address_tokens", ADDRESS_STOP, "ae"))
    return records.select(*_keys(records), *(others or []), words.alias("words"))


def _exact() -> Column:
    return F.transform("words", lambda w: F.struct(w["kind"].alias("kind"), F.concat_ws(":", w["kind"], w["token"]).alias("signature")))


def _shape(w: Column) -> Column:
    kind, token = F.when(w["kind"] == "ne", "ns").otherwise("as"), w["token"]
    ends = F.concat(F.substring(token, 1, 2), F.right(token, F.lit(2)))
    return F.struct(kind.alias("kind"), F.concat(kind, F.lit(":"), ends, F.lit(":"), F.floor(F.length(token) / 3).cast("string")).alias("signature"))


def _shapes() -> Column:
    long = F.filter(F.col("words"), lambda w: (F.length(w["token"]) >= 6) & ~w["token"].rlike("^[0-9]+$"))
    return F.array_distinct(F.transform(long, _shape))


def _items(longest: int) -> Column:
    """The longest words, by length, then kind, then word."""
    keyed = F.transform("words", lambda w: F.struct((-F.length(w["token"])).alias("l"), w["kind"].alias("kind"), w["token"].alias("token")))
    return F.transform(F.slice(F.array_sort(keyed), 1, longest), lambda w: F.concat_ws(":", w["kind"], w["token"]))


def _pairs(longest: int) -> Column:
    joined = F.transform("items", lambda a, i: F.transform(F.slice("items", i + 2, longest), lambda b: F.concat_ws("|", a, b)))
    return F.transform(F.flatten(joined), lambda p: F.struct(F.lit("pe").alias("kind"), p.alias("signature")))


def _exploded(rows: DataFrame, made: Column, keys: list[str]) -> DataFrame:
    return rows.select(*keys, F.explode(made).alias("s")).select(*keys, "s.kind", "s.signature")


def exact_signatures(records: DataFrame) -> DataFrame:
    """entity_id, country, kind (ne, ae) and signature, kind:word, for words of three or more characters that aren't stop words."""
    return _exploded(_with_words(records), _exact(), _keys(records))


def shape_signatures(records: DataFrame) -> DataFrame:
    """entity_id, country, kind (ns, as) and signature: the first and last two characters and a third of the length, of longer words with a letter."""
    return _exploded(_with_words(records), _shapes(), _keys(records))


def single_signatures(records: DataFrame) -> DataFrame:
    """Exact words and typing shapes, by one explode."""
    return _exploded(_with_words(records), F.concat(_exact(), _shapes()), _keys(records))


def longest_words(records: DataFrame, longest: int = LinkConfig.longest_tokens) -> DataFrame:
    """entity_id, country and items: the longest words, kind:word, in order."""
    return _with_words(records).select(*_keys(records), _items(longest).alias("items"))


def pair_signatures(records: DataFrame, longest: int = LinkConfig.longest_tokens) -> DataFrame:
    """entity_id, country, kind (pe) and signature of every pair of the longest words. No join."""
    return _exploded(longest_words(records, longest), _pairs(longest), _keys(records))


def all_signatures(records: DataFrame, longest: int = LinkConfig.longest_tokens) -> DataFrame:
    """All of them, by one pass over the records and one explode; target_source comes along where records have it."""
    words = _with_words(records).withColumn("items", _items(longest))
    return _exploded(words, F.concat(_exact(), _shapes(), _pairs(longest)), _keys(records))


def triple_signatures(records: DataFrame, hot: DataFrame, longest: int = LinkConfig.longest_tokens) -> DataFrame:
    """Signatures of kind pt for the pairs of the longest words that are in `hot`: each with every third word; distinct.

    hot: country and signature of the pairs, and target_source where records have it.
    """
    keys = _keys(records)
    on = [c for c in keys if c != "entity_id"]
    paired = longest_words(records, longest).select(*keys, "items", F.explode(_pairs(longest)).alias("s")).select(*keys, "items", F.col("s.signature").alias("signature"))
    two = F.split("signature", r"\|")
    # the words stay in their order, so a triple is the same whichever of its pairs is hot
    triples = F.transform(F.array_except("items", "two"), lambda third: F.concat_ws("|", F.filter("items", lambda w: F.array_contains("two", w) | (w == third))))
    found = paired.join(hot.select(*on, "signature").distinct(), [*on, "signature"], "left_semi").withColumn("two", two)
    return found.select(*keys, F.lit("pt").alias("kind"), F.explode(triples).alias("signature")).distinct()
