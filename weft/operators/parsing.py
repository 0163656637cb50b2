"""Separate rows that fail to parse, with the reason, by a minimum-cost error parse.

The grammar: fields are parted by tabs; a field that starts with a quote ends at its closing quote, may hold tabs, and shows an
inner quote doubled; after the closing quote comes a tab or the end; elsewhere a quote is an ordinary character.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType

START, PLAIN, INSIDE, CLOSED = range(4)
#: What a quote (q), a tab (t) or a run of other characters (x) does in each state. A missing entry is an error.
STEPS = {
    START: {"q": (INSIDE, 0), "t": (START, 1), "x": (PLAIN, 0)},
    PLAIN: {"q": (PLAIN, 0), "t": (START, 1), "x": (PLAIN, 0)},
    INSIDE: {"q": (CLOSED, 0), "t": (INSIDE, 0), "x": (INSIDE, 0)},
    CLOSED: {"q": (INSIDE, 0), "t": (START, 1)},
}
#: What an inserted quote or delimiter does.
INSERTS = {START: [("+quote", INSIDE, 0), ("+tab", START, 1)], PLAIN: [("+tab", START, 1)], INSIDE: [("+quote", CLOSED, 0)], CLOSED: [("+quote", INSIDE, 0), ("+tab", START, 1)]}
ENDS = (START, PLAIN, CLOSED)
RUNS = re.compile(r'[^"\t]+')


def shape(text: str) -> str:
    """The text with each quote as q, each tab as t and each run of other characters as one x."""
    return RUNS.sub("x", text).replace('"', "q").replace("\t", "t")


@lru_cache(maxsize=65536)
def least_edits(form: str, fields: int) -> tuple[int, int, str]:
    """The cheapest way to read a shape as `fields` fields (0: any number).

    Returns the edits of quotes without which no number of fields can be read, the number of fields that are there when that is 0
    (else -1), and the edits of the cheapest whole repair. A state of the dynamic programme is a state of the grammar with the
    number of delimiters so far (counted up to one more than wanted); a step reads a symbol, drops a quote or delimiter at cost 1,
    or, before a symbol or the end, puts one in at cost 1.
    """

    def insert(best: dict, quotes_only: bool) -> dict:
        queue = list(best)
        while queue:
            state, n = queue.pop(0)
            cost, edits = best[state, n]
            for name, to, more in INSERTS[state]:
                if quotes_only and name != "+quote":
                    continue
                key = (to, 0 if quotes_only else min(n + more, limit))
                if key not in best or best[key][0] > cost + 1:
                    best[key] = (cost + 1, (edits, name))
                    queue.append(key)
        return best

    def run(quotes_only: bool) -> tuple[int, tuple | None]:
        best: dict = {(START, 0): (0, None)}
        for symbol in form:
            best, old = {}, insert(dict(best), quotes_only)
            for (state, n), (cost, edits) in old.items():
                moves = []
                if symbol in STEPS[state]:
                    to, more = STEPS[state][symbol]
                    moves.append((to, more, 0, None))
                if symbol == "q":
                    moves.append((state, 0, 1, "-quote"))
                if symbol == "t" and not quotes_only:
                    moves.append((state, 0, 1, "-tab"))
                for to, more, extra, name in moves:
                    key = (to, 0 if quotes_only else min(n + more, limit))
                    if key not in best or best[key][0] > cost + extra:
                        best[key] = (cost + extra, (edits, name) if name else edits)
        best = insert(best, quotes_only)
        ends = [v for (state, n), v in best.items() if state in ENDS and (quotes_only or not fields or n == fields - 1)]
        return min(ends, key=lambda v: v[0])

    limit = fields if fields else 0
    quotes, _ = run(quotes_only=True)
    there = -1
    if quotes == 0:
        state, there = START, 1
        for symbol in form:
            state, more = STEPS[state][symbol]
            there += more
    _, chain = run(quotes_only=False)
    edits: list[str] = []
    while chain:
        chain, name = chain
        edits.append(name)
    return quotes, there, " ".join(reversed(edits))


def split_fields(text: str) -> list[str]:
    """The fields of a text that reads at no cost, outer quotes removed and doubled ones made single."""
    if '"' not in text:
        return text.split("\t")
    out, at = [], 0
    while True:
        if text.startswith('"', at):
            end = at + 1
            while True:
                end = text.index('"', end)
                if text.startswith('""', end):
                    end += 2
                else:
                    break
            out.append(text[at + 1 : end].replace('""', '"'))
            at = end + 1
        else:
            end = text.find("\t", at)
            end = len(text) if end < 0 else end
            out.append(text[at:end])
            at = end
        if at >= len(text):
            return out
        at += 1


def parse_lines(df: DataFrame, line: str, columns: list[str], keep: list[str]) -> DataFrame:
    """Read every line as tab-separated fields.

    Result: the columns `keep`, the fields as `columns` (null where the line can't be read as just so many), broken ('quoting',
    'column_count' or null) and edits, the cheapest repair ('' when there is none to make). A null line counts as an empty one.
    A line of any length is read whole. Columns of the input that aren't in `keep` are dropped, so no name can clash.
    """
    wanted = len(columns)
    kept = df.select(*[F.col(c) for c in keep], F.coalesce(F.col(line), F.lit("")).alias("__line"))
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema.fields if f.name != "__line")
    schema = f"{fields}, {', '.join(f'`{c}` string' for c in columns)}, broken string, edits string"

    def read(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            parsed = []
            for text in frame["__line"]:
                quotes, there, edits = least_edits(shape(text), wanted)
                broken = "quoting" if quotes else "column_count" if there != wanted else None
                parsed.append([*(split_fields(text) if broken is None else [None] * wanted), broken, edits])
            values = pd.DataFrame(parsed, columns=[*columns, "broken", "edits"], index=frame.index, dtype=object)
            yield pd.concat([frame.drop(columns="__line"), values], axis=1)

    return kept.mapInPandas(read, schema)


@F.pandas_udf(IntegerType())
def _quote_edits(shapes: pd.Series) -> pd.Series:
    # a value without a quote, whose shape is null, reads as it is
    return shapes.map(lambda s: least_edits(s.replace('"', "q").replace("\t", "t"), 0)[0] if s else 0)


def quote_edits(value: Column) -> Column:
    """How many quotes must be put into or taken out of a value so that it reads; 0: it is well quoted. Only the shape goes to Python."""
    return _quote_edits(F.when(value.contains('"'), F.regexp_replace(value, '[^"\t]+', "x")))


def bad_id(value: Column, prefix: Column) -> Column:
    """Not exactly the prefix and nine digits; a null breaks the rule too."""
    return ~F.coalesce(value.rlike(r"^S[0-9]-[0-9]{9}\z") & value.startswith(prefix), F.lit(False))


def bad_content(content: Column, tab_allowed: Column) -> Column:
    """Of the content of an address field: not empty, and without a letter or with a control character that isn't an allowed tab."""
    text = F.coalesce(content, F.lit(""))
    control = F.when(tab_allowed, text.rlike("[\\x00-\\x08\\x0a-\\x1f\\x7f]")).otherwise(text.rlike("[\\x00-\\x1f\\x7f]"))
    return (text != "") & (~text.rlike("\\p{L}") | control)


#: The columns of a delivered record, in order.
RECORD = ["entity_id", "business_name", "business_address", "country"]


def read_deliveries(lines: DataFrame) -> DataFrame:
    """Parse delivered lines into records, with the first rule that a line breaks as its reason.

    Input: line_id, file_name, line_text. Result: line_id, file_name, the four columns of a record, reason (null: a valid record),
    edits. The reasons, in this order: quoting, column_count, entity_id, business_address. An unknown or null file_name has no
    valid prefix, so its lines break entity_id. Repeated lines stay, each with its line_id.
    """
    parsed = parse_lines(lines.withColumn("__quoted", F.col("line_text").contains('"')), "line_text", RECORD, ["line_id", "file_name", "__quoted"])
    prefix = F.when(F.col("file_name") == "train_source1.tsv", "S1-").when(F.col("file_name") == "train_source2.tsv", "S2-").otherwise(F.lit("\u0000"))
    reason = (
        F.when(F.col("broken").isNotNull(), F.col("broken"))
        .when(bad_id(F.col("entity_id"), prefix), "entity_id")
        # a parsed field can hold a tab only within quotes
        .when(bad_content(F.col("business_address"), F.lit(True)), "business_address")
    )
    return parsed.select("line_id", "file_name", *RECORD, reason.alias("reason"), "edits")


def check_ids(records: DataFrame, prefix: str) -> DataFrame:
    """entity_id and reason of loaded records whose entity_id isn't the prefix and nine digits; a null id is given as ''."""
    return records.where(bad_id(F.col("entity_id"), F.lit(prefix))).select(F.coalesce("entity_id", F.lit("")).alias("entity_id"), F.lit("entity_id").alias("reason"))


def address_reason(value: Column) -> Column:
    """Why an address, as one field, breaks the format; null if it doesn't."""
    address = F.coalesce(value, F.lit(""))
    one_field = address.rlike('(?s)^"(?:[^"]++|"")*+"\\z')
    content = F.when(one_field, F.replace(F.substr(address, F.lit(2), F.length(address) - 2), F.lit('""'), F.lit('"'))).otherwise(address)
    return F.when(quote_edits(value) > 0, "quoting").when(bad_content(content, one_field), "business_address")


def check_addresses(records: DataFrame) -> DataFrame:
    """entity_id and reason of loaded records whose business_address breaks the rules of quoting or content, taken as one field.

    A value in correct quotes is judged by its content, in which tabs are allowed. Null and empty addresses are valid. Rows that
    come several times give several equal rows here.
    """
    checked = records.select(F.coalesce("entity_id", F.lit("")).alias("entity_id"), address_reason(F.col("business_address")).alias("reason"))
    return checked.where("reason is not null")


def failures(lines: DataFrame, source1: DataFrame, source2: DataFrame) -> DataFrame:
    """All lines and loaded values that break the format: record_table, record_key, reason; distinct rows."""
    parts = [
        read_deliveries(lines).where("reason is not null").select(F.lit("raw_source_lines").alias("record_table"), F.col("line_id").cast("string").alias("record_key"), "reason"),
        check_ids(source1, "S1-").select(F.lit("train_source1").alias("record_table"), F.col("entity_id").alias("record_key"), "reason"),
        check_addresses(source2).select(F.lit("train_source2").alias("record_table"), F.col("entity_id").alias("record_key"), "reason"),
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).distinct()


def valid_source1(records: DataFrame) -> DataFrame:
    """Records of source 1 with a valid entity_id."""
    return records.where(~bad_id(F.col("entity_id"), F.lit("S1-")))


def valid_source2(records: DataFrame) -> DataFrame:
    """Rows of source 2 whose address isn't broken; rows of one entity_id have the same values, so no join is needed."""
    return records.where(address_reason(F.col("business_address")).isNull())
