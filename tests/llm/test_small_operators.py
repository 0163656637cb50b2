import heapq
import random
from collections import defaultdict

import pytest

from tests.conftest import rows
from tests.oracle_check import agree
from weft.llm import lookalike, mojibake, packing, queries, tokens, topn

DOCS = "doc_id long, text string"


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_query_equals_its_sql(spark, small, name):
    agree(spark, small, queries.queries()[name], queries.oracle_sql()[name])


@pytest.mark.parametrize("name", sorted(queries.queries()))
def test_every_query_runs(spark, small, name):
    df = queries.queries()[name](spark, small)
    assert df.count() > 0
    assert df.distinct().count() == df.count()


# the N best of each group


def test_top_n_equals_brute_force(spark):
    random.seed(5)
    data = [(random.choice([1, 1, 1, 2, 3, None]), random.choice([0.1, 0.5, 0.9, None]), f"i{random.randint(0, 400)}") for _ in range(3000)]
    got = topn.top_n(spark.createDataFrame(data, "g int, s double, i string").selectExpr("*", "1 as __salt", "'x' as rank_in_group"), "g", "s", "i", 5)
    groups = defaultdict(list)
    for g, s, i in data:
        groups[g].append((s is None, -(s or 0), i, s))
    want = sorted(((g, k + 1, i, s) for g, v in groups.items() for k, (_, _, i, s) in enumerate(heapq.nsmallest(5, v))), key=str)
    assert sorted(((r.g, r.rank_in_group, r.i, r.s) for r in got.collect()), key=str) == want


def test_candidates_and_scores(spark):
    pairs = spark.createDataFrame([("S1-0005", " S2-1, ,S2-2,S2-1"), ("S1-0005 ", "S3-1"), ("S1-6", None), ("S1-7", ""), ("x", "S2-1"), (None, "S2-1")], "source1_entity_id string, candidate_entity_ids string")
    scores = [(5, 2, "S2-1", 0.5), (5, 2, "S2-1", 0.7), (5, 2, "S2-2", 1.5), (5, 3, "S3-1", 0.7), (5, 3, "S3-9", 0.9), (6, 2, "S2-1", 0.9), (5, 2, "S2-2", None), (5, 2, "S2-2", float("nan"))]
    predictions = spark.createDataFrame(scores, "query_rid long, target_source int, target_entity_id string, probability double")
    assert [tuple(r) for r in topn.best_candidates(pairs, predictions).orderBy("rank_in_group").collect()] == [(5, "S2-1", 0.7, 1), (5, "S3-1", 0.7, 2)]
    assert topn.best_candidates(pairs.limit(0), predictions).count() == 0


# look-alikes

COUNTS = {chr(c): 1 for c in range(0x20, 0x30000) if not 0xD800 <= c < 0xE000} | {c: 1000 for c in "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ éüñöä"}
REWRITER = lookalike.build_rewriter(COUNTS)
#: Spoilt texts with what plain typing gives.
SPOILT = [
    ("Cаfé", "Café"), ("Café", "Café"), ("Ｆｏｏｄｓ　Ｌｔｄ", "Foods Ltd"), ("Foo​ds", "Foods"), ("Foods Ltd", "Foods Ltd"), ("ﬁne", "fine"), ("𝖯𝗈𝗉𝗉𝗒 X", "Poppy X"),
    ("GmbН", "GmbH"), ("Βаkery", "Bakery"), ("LLС Foods", "LLC Foods"), ("Aптека", "Аптека"), ("Kent", "Kent"), ("a‑b", "a-b"), ("Main St", "Main St"), ("x­y", "xy"),
]
PLAIN = ["", " ", "Café  LTD", "Σύμβουλοι Γραφείο", "Живкова Бряг", "क्‍षेत्र बाज़ार", "サクラ　ホテル", "Улица 5", "Straße 12", "½ price ²", "O’Neil – x", "РЕТРО", "می‌خواهم"]


@pytest.mark.parametrize(("spoilt", "plain"), SPOILT)
def test_look_alikes_are_rewritten(spoilt, plain):
    assert REWRITER.rewrite(spoilt) == plain
    assert REWRITER.rewrite(plain) == plain


@pytest.mark.parametrize("text", PLAIN)
def test_plain_text_stays(text):
    assert REWRITER.rewrite(text) == text


def test_look_alike_table(spark):
    schema = "entity_id string, business_name string, value string, c string"
    data = [("a", None, "", ""), ("b", "", "", ""), ("c", "Fооds", "", ""), ("d", "Foods " * 3000 + "Ｘ", "", ""), ("c", "Fооds", "", "")]
    got = lookalike.plain_forms([(spark.createDataFrame(data, schema), "business_name", "t")])
    assert rows(got.select("entity_id", "looks_typed")) == [("a", True), ("b", True), ("c", False), ("c", False), ("d", False)]
    assert lookalike.plain_forms([(spark.createDataFrame([], schema), "business_name", "t")]).count() == 0


# tokens


def test_encoder_equals_libraries():
    tiktoken = pytest.importorskip("tiktoken")
    tool = tokens.encoder()
    ranks = {t: i for i, t in enumerate(tool.tokens) if t}
    other = tiktoken.Encoding("own", pat_str=tokens.PATTERN, mergeable_ranks=ranks, special_tokens={})
    random.seed(7)
    alphabet = "abcdeing thersABC ée日本🙂   \n!!??--012'’sй"
    for _ in range(1500):
        text = "".join(random.choices(alphabet, k=random.randint(0, 60)))
        assert tool.encode(text) == other.encode_ordinary(text)
    for text in ("a" * 5000, " " * 999, "the" * 900, "<|endoftext|>", "\n\n \n"):
        assert tool.encode(text) == other.encode_ordinary(text)
        assert tool.decode(tool.encode(text)) == text


def test_corpus_round_trip(spark):
    texts = [(1, None), (2, ""), (3, " \n"), (4, "Größe 12 €"), (5, "word " * 30000), (4, "Größe 12 €")]
    encoded = tokens.encode_corpus(spark.createDataFrame(texts, DOCS).selectExpr("*", "'x' as ids"))
    assert {r.doc_id: len(r.ids) for r in encoded.collect()}[2] == 0
    assert rows(tokens.decode_corpus(encoded)) == sorted((i, t or "") for i, t in texts)
    assert tokens.encode_corpus(spark.createDataFrame([], DOCS)).count() == 0


# containers


def test_histogram_packing_is_tight():
    random.seed(11)
    for lengths in ((1024,), (256, 512, 1024)):
        histogram = {s: random.randint(0, 300) for s in range(1, 400, 3)}
        slots, containers = packing.pack_histogram(histogram, lengths)
        volume = sum(s * n for s, n in histogram.items())
        assert sum(s.size * s.each * s.times for s in slots) == volume
        capacity = sum({s.first: s.capacity * s.times for s in slots}.values())
        assert volume <= capacity <= 1.01 * volume + 1024
        room = defaultdict(int)
        for slot in slots:
            for k in range(slot.times):
                room[slot.first + k] += slot.size * slot.each
                assert room[slot.first + k] <= slot.capacity
        by_size = defaultdict(list)
        for slot in slots:
            by_size[slot.size] += [(slot.base, slot.base + slot.each * slot.times)]
        assert all(sorted(v)[0][0] == 0 and all(a[1] == b[0] for a, b in zip(sorted(v), sorted(v)[1:], strict=False)) for v in by_size.values())
    one_cost = packing.pack_histogram({700: 3, 200: 1}, (256, 512, 1024), (1, 1, 1))
    assert one_cost[1] == 3 and {s.capacity for s in one_cost[0]} == {1024}
    assert packing.pack_histogram({}, (1024,)) == ([], 0)
    assert packing.pack_histogram({700: 3}, (256, 1024))[1] == 3


def first_fit_decreasing(items, capacity=1024):
    room = []
    for size in sorted(items, reverse=True):
        at = next((i for i, r in enumerate(room) if r >= size), None)
        if at is None:
            room.append(capacity - size)
        else:
            room[at] -= size
    return room


def test_items_are_placed_whole_and_once(spark):
    random.seed(12)
    texts = [(i, "word " * random.choice([0, 1, 5, 60, 60, 60, 700])) for i in range(400)] + [(1000, None), (1001, "w " * 5000)]
    placed = packing.pack_documents(spark.createDataFrame(texts, DOCS)).collect()
    tool = tokens.encoder()
    sizes, used, pieces = defaultdict(int), defaultdict(list), defaultdict(int)
    for r in placed:
        sizes[r.doc_id] += r.n_tokens
        pieces[r.doc_id] += 1
        used[r.container_id] += range(r.start, r.start + r.n_tokens)
    assert sizes == {i: len(tool.encode(t)) for i, t in texts}
    assert all(n == max(1, -(-sizes[i] // 1024)) for i, n in pieces.items())
    assert all(len(set(v)) == len(v) and max(v, default=0) < 1024 for v in used.values())
    assert len(used) <= len(first_fit_decreasing([min(1024, n - k) for n in sizes.values() for k in range(0, n, 1024)]))
    assert packing.pack_documents(spark.createDataFrame([], DOCS)).count() == 0
    assert {r.n_tokens for r in packing.pack_documents(spark.createDataFrame([(1, ""), (2, None)], DOCS)).collect()} == {0}


# wrong encodings

CLEAN = [
    "Très léger, silencieux et facile à nettoyer. Rien à redire, déçu pourtant.", "Größe stimmt überhaupt nicht, aber schön und für den Preis in Ordnung.", "Después de 68 semanas sigue como el primer día, mañana pido otro.",
    "Silny, głośny i łatwy w czyszczeniu, część jest solidna, wciąż działa.", "Продавец не ответил ни на одно из моих сообщений, деньги не вернули.", "It’s fine – good café, worth €20.", "NÃO COMPREM, A PROTEÇÃO É NULA. Coração.",
]


def garble(text, written_in, read_as):
    table = mojibake.char_of(read_as)
    return "".join(table[b] if b > 127 else chr(b) for b in text.encode(written_in))


def test_garbled_texts_are_found_and_restored(spark):
    clean = [(i, CLEAN[i % len(CLEAN)] + f" {i}") for i in range(700)]
    spoilt = [(9000, garble(CLEAN[0], "utf-8", "cp1252"), CLEAN[0]), (9001, garble(CLEAN[1], "utf-8", "latin-1"), CLEAN[1]), (9002, garble(CLEAN[4], "utf-8", "cp1251"), CLEAN[4]), (9003, garble(CLEAN[2], "cp1252", "cp850"), CLEAN[2])]
    spoilt += [(9004, garble(garble(CLEAN[1], "utf-8", "cp1252"), "utf-8", "cp1252"), CLEAN[1]), (9005, garble(CLEAN[3], "utf-8", "mac_roman"), CLEAN[3]), (9006, garble(CLEAN[4], "cp1251", "latin-1"), CLEAN[4])]
    lost = [(9100, "La citt� � umida.", None)]
    extra = [(9200, None), (9201, ""), (9202, "⭐⭐⭐"), (9203, "plain " * 50000)]
    docs = spark.createDataFrame(clean + extra + [d[:2] for d in spoilt + lost], DOCS).selectExpr("*", "'x' as repaired", "1 as sort")
    found = {r.doc_id: (r.repaired, r.restored) for r in mojibake.find_garbled(docs).collect()}
    assert set(found) == {d[0] for d in spoilt + lost}
    assert all(found[i] == (original, True) for i, _, original in spoilt)
    assert found[9100][1] is False
    assert mojibake.find_garbled(spark.createDataFrame([], DOCS)).count() == 0


def test_undo_inverts_every_pair():
    for read_as in ("cp1252", "latin-1", "cp437", "mac_roman", "koi8-r"):
        for text in ("é", "ß€", "Привет"):
            assert mojibake.undo(garble(text, "utf-8", read_as), read_as, "utf-8") == (text, 0, 0)


def test_labels_are_the_same_if_suspect_stretches_are_too_many_to_send(spark, monkeypatch):
    data = [(i, CLEAN[i % len(CLEAN)] + f" {i}") for i in range(300)] + [(900 + i, garble(CLEAN[i], "utf-8", "cp1252")) for i in range(3)]
    docs = spark.createDataFrame(data, DOCS)
    sent = rows(mojibake.find_garbled(docs))
    monkeypatch.setattr(mojibake, "FEW", 0)
    assert mojibake.train(docs).known is None
    assert rows(mojibake.find_garbled(docs)) == sent and len(sent) == 3
