"""SQL that says in another engine's dialect what the core queries compute, over the same tables."""

from __future__ import annotations

from weft.config import ADDRESS_STOP, KIND_WEIGHTS, LEGAL_WORDS, NAME_STOP, PAIR_WEIGHT, RECORD_COLUMNS, LinkConfig

CONFIG = LinkConfig()


def _list(words: list[str]) -> str:
    return ", ".join(f"'{w}'" for w in words)


def _norm(column: str) -> str:
    return rf"trim(regexp_replace(strip_accents(lower({column})), '[^\p{{L}}\p{{N}}]+', ' ', 'g'))"


LEGAL = f" ({'|'.join(LEGAL_WORDS)}) "


def _records(name: str, source: int) -> str:
    return f"""
{name}_raw as (select distinct entity_id, coalesce(business_name, '') business_name, coalesce(business_address, '') business_address,
  trim(coalesce(country, '')) country from train_source{source}),
{name}_norm as (select *, {_norm('business_name')} name_norm, {_norm('business_address')} address_norm from {name}_raw),
{name} as (select {source} target_source, entity_id, country, name_norm, address_norm,
  trim(regexp_replace(regexp_replace(' ' || name_norm || ' ', '{LEGAL}', ' ', 'g'), '{LEGAL}', ' ', 'g')) core_name,
  list_sort(list_distinct(list_filter(string_split(name_norm, ' '), lambda t: length(t) >= 2))) name_tokens,
  list_sort(list_distinct(list_filter(string_split(address_norm, ' '), lambda t: length(t) >= 2))) address_tokens,
  list_sort(list_distinct(regexp_extract_all(name_norm || ' ' || address_norm, '[0-9]+'))) digit_tokens
  from {name}_norm)"""


SOURCES = ", ".join([_records("q", 1), _records("t2", 2), _records("t3", 3), "t as (select * from t2 union all select * from t3)"])


def _signatures(name: str, records: str, longest: int = CONFIG.longest_tokens) -> str:
    """CTEs {name}_words (a row for each word), {name}_exact, {name}_shape, {name}_pair and {name} (all)."""
    return f"""
{name}_words as (
  select target_source, entity_id, country, 'ne' kind, w token from (select *, unnest(name_tokens) w from {records}) where length(w) >= 3 and w not in ({_list(NAME_STOP)})
  union all
  select target_source, entity_id, country, 'ae', w from (select *, unnest(address_tokens) w from {records}) where length(w) >= 3 and w not in ({_list(ADDRESS_STOP)})),
{name}_exact as (select target_source, entity_id, country, kind, kind || ':' || token signature from {name}_words),
{name}_shape as (select distinct target_source, entity_id, country, case kind when 'ne' then 'ns' else 'as' end kind,
  case kind when 'ne' then 'ns:' else 'as:' end || left(token, 2) || right(token, 2) || ':' || cast(length(token) // 3 as varchar) signature
  from {name}_words where length(token) >= 6 and not regexp_matches(token, '^[0-9]+$')),
{name}_items as (select *, row_number() over (partition by target_source, entity_id order by length(token) desc, kind, token) pos from {name}_words),
{name}_pair as (select a.target_source, a.entity_id, a.country, 'pe' kind, a.kind || ':' || a.token || '|' || b.kind || ':' || b.token signature
  from {name}_items a join {name}_items b using (target_source, entity_id) where a.pos < b.pos and b.pos <= {longest}),
{name} as (select * from {name}_exact union all select * from {name}_shape union all select * from {name}_pair)"""


def _triples(name: str, records: str, hot: str, on: str) -> str:
    """CTE {name}: of every pair of the longest words that is hot each with every third word; words stay in their order."""
    return f"""
{name}_hot as (select a.target_source, a.entity_id, a.country, a.pos i, b.pos j from {records}_items a join {records}_items b using (target_source, entity_id)
  where a.pos < b.pos and b.pos <= {CONFIG.longest_tokens} and exists (select 1 from {hot} h where {on} h.country = a.country and h.signature = a.kind || ':' || a.token || '|' || b.kind || ':' || b.token)),
{name}_at as (select distinct h.target_source, h.entity_id, h.country, list_sort([i, j, c.pos]) places from {name}_hot h join {records}_items c
  on c.target_source = h.target_source and c.entity_id = h.entity_id where c.pos <> i and c.pos <> j and c.pos <= {CONFIG.longest_tokens}),
{name} as (select x.target_source, x.entity_id, x.country, 'pt' kind, string_agg(w.kind || ':' || w.token, '|' order by w.pos) signature
  from {name}_at x join {records}_items w on w.target_source = x.target_source and w.entity_id = x.entity_id and list_contains(x.places, w.pos)
  group by x.target_source, x.entity_id, x.country, x.places)"""


def _index(bound: int = CONFIG.max_pair_frequency) -> str:
    cases = " ".join(f"when '{k}' then {v}" for k, v in KIND_WEIGHTS.items())
    return f"""
df as (select target_source, country, kind, signature, count(*)::int document_frequency from ts where kind <> 'pe' group by all),
n as (select target_source, country, count(*) country_count from t group by all),
hot as (select target_source, country, signature from ts where kind = 'pe' group by all having count(*) > {bound}),
{_triples('tt', 'ts', 'hot', 'h.target_source = a.target_source and')},
{_triples('qt', 'qs', 'hot', '')},
idx as (
  select ts.target_source, ts.entity_id, ts.country, ts.kind, ts.signature, df.document_frequency,
    cast(round(ln((country_count + 1.0::double) / (document_frequency + 0.5::double)) * (case kind {cases} end)::double * 1e6) as bigint) weight_micro
  from ts join df using (target_source, country, kind, signature) join n using (target_source, country)
  where (kind in ('ne', 'ae') and document_frequency <= {CONFIG.max_token_frequency}) or (kind in ('ns', 'as') and document_frequency <= {CONFIG.max_shape_frequency})
  union all
  select target_source, entity_id, country, kind, signature, 1, {int(PAIR_WEIGHT * 1e6)} from ts where kind = 'pe' and (target_source, country, signature) not in (select * from hot)
  union all
  select target_source, entity_id, country, kind, signature, 1, {int(PAIR_WEIGHT * 1e6)} from
    (select *, count(*) over (partition by target_source, country, signature) c from tt) where c <= {bound}),
qall as (select * from qs union all select * from qt)"""


def _recall_stages() -> str:
    asked = "asked as (select * from truth where source1_entity_id in (select entity_id from lq))"
    parts = []
    for blank in ("false", "true"):
        # a query of any country looks under '' too
        whole = CANDIDATES if blank == "false" else CANDIDATES.replace("join idx using (country, kind, signature)", "join idx on idx.country in (qall.country, '') and idx.kind = qall.kind and idx.signature = qall.signature")
        # triples of pairs that are hot only among targets without a country
        whole = whole if blank == "false" else whole.replace("where  h.country = a.country", "where h.country in (a.country, '')")
        for stage, found in (("1 raw", "raw"), ("2 shortlist", "short"), ("3 final", "cand")):
            parts.append(f"""select * from ({whole}, {asked} select {blank} blank_country, '{stage}' stage, count(*) truth_links, count(c.query_id) captured, round(count(c.query_id) / count(*), 6) recall
              from asked left join (select distinct query_id, target_id from {found}) c on c.query_id = source1_entity_id and c.target_id = asked.target_id)""")
    return " union all ".join(parts)


RAW = """
raw as (select qall.entity_id query_id, idx.target_source, idx.entity_id target_id, sum(weight_micro)::bigint score_micro,
  count(*) filter (qall.kind in ('ne', 'ae', 'pe', 'pt'))::int exact_hits, count(*) filter (qall.kind in ('ns', 'as'))::int shape_hits
  from qall join idx using (country, kind, signature) group by all)"""
SHORT = f"""
short as (select * exclude (r) from (select *, row_number() over (partition by query_id, target_source order by score_micro desc, exact_hits desc, target_id) r from raw)
  where r <= {CONFIG.prefilter_candidates})"""
TOP = f"""
scored as (select s.*, jaro_winkler_similarity(q.name_norm, t.name_norm) name_jaro,
  case when q.address_norm = '' or t.address_norm = '' then 0.0 else jaro_winkler_similarity(q.address_norm, t.address_norm) end address_jaro
  from short s join q on q.entity_id = s.query_id join t on t.entity_id = s.target_id and t.target_source = s.target_source),
cand as (select query_id, target_source, target_id, score_micro / 1e6 block_score, exact_hits, shape_hits, rk::int candidate_rank, name_jaro, address_jaro
  from (select *, row_number() over (partition by query_id, target_source order by
    round(score_micro / 1e6 + 7.0 * greatest(name_jaro, address_jaro) + 2.0 * (name_jaro + address_jaro), 6) desc, exact_hits desc, target_id) rk from scored)
  where rk <= {CONFIG.max_candidates_per_source})"""
# ids are compared as text; lists are separated by commas, sometimes with blanks
TRUTH = "truth as (select distinct trim(source1_entity_id, ' ') source1_entity_id, trim(x, ' ') target_id from (select source1_entity_id, unnest(string_split(matched_entity_ids, ',')) x from train_matches) where trim(x, ' ') <> '')"
LABELLED = "lq as (select * from q where entity_id in (select trim(source1_entity_id, ' ') from train_matches))"

BOTH = f"with {SOURCES}, {_signatures('qs', 'q')}, {_signatures('ts', 't')}, {_index()}, {RAW}"
CANDIDATES = f"{BOTH}, {SHORT}, {TOP}, {TRUTH}, {LABELLED}"
SCORED = f"""{CANDIDATES},
pr as (select query_id, target_source, c.target_id, round(0.5 * (name_jaro + address_jaro), 9) probability, (truth.target_id is not null)::int "label"
  from cand c left join truth on truth.source1_entity_id = query_id and truth.target_id = c.target_id where query_id in (select entity_id from lq)),
tc as (select entity_id query_id, count(truth.target_id) truth_count from lq left join truth on truth.source1_entity_id = entity_id group by all)"""
ENTITY = "case when truth_count = 0 and p = 0 then 1.0 when truth_count > 0 and p > 0 and h > 0 then 1.25 * (h / p) * (h / truth_count) / (0.25 * (h / p) + h / truth_count) else 0.0 end"
SWEEP = f"""{SCORED},
points as (select round(0.10 + i * ((0.995 - 0.10) / 179), 9) threshold from range(180) r(i)
  union select round(unnest(quantile_cont(probability, [{', '.join(repr(0.5 + i * (0.999 - 0.5) / 99) for i in range(100))}])), 9) from pr),
per as (select threshold, tc.query_id, truth_count, count(pr.query_id) filter (probability >= threshold) p, coalesce(sum("label") filter (probability >= threshold), 0) h
  from points cross join tc left join pr on pr.query_id = tc.query_id group by all),
sweep as (select threshold, avg({ENTITY}) macro_f05 from per group by threshold)"""


def _jac(column: str) -> str:
    both = f"len(list_distinct(list_concat(q.{column}, t.{column})))"
    return f"case when {both} = 0 then 1.0 else len(list_intersect(q.{column}, t.{column})) / {both} end"


def _lev(column: str) -> str:
    longer = f"greatest(length(q.{column}), length(t.{column}))"
    return f"case when {longer} = 0 then 1.0 else 1.0 - levenshtein(q.{column}, t.{column}) / {longer}::double end"


def _char(column: str) -> str:
    return f"case when q.{column} = '' or t.{column} = '' then 0.0 else jaccard(q.{column}, t.{column}) end"


def _ratio(column: str) -> str:
    return f"least(length(q.{column}), length(t.{column})) / greatest(1, length(q.{column}), length(t.{column}))::double"


PAIR_FEATURES = f"""{CANDIDATES},
f as (select query_id, c.target_source, target_id, q.country, block_score, exact_hits, shape_hits,
  (q.name_norm = t.name_norm)::int name_exact, (q.core_name <> '' and q.core_name = t.core_name)::int core_name_exact,
  (q.address_norm <> '' and q.address_norm = t.address_norm)::int address_exact, name_jaro,
  jaro_winkler_similarity(q.core_name, t.core_name) core_name_jaro, address_jaro,
  {_lev('name_norm')} name_levenshtein, {_lev('core_name')} core_name_levenshtein,
  case when q.address_norm = '' or t.address_norm = '' then 0.0 else {_lev('address_norm')} end address_levenshtein,
  {_char('name_norm')} name_char_jaccard, {_char('address_norm')} address_char_jaccard,
  {_jac('name_tokens')} name_token_jaccard, {_jac('address_tokens')} address_token_jaccard,
  len(list_intersect(q.name_tokens, t.name_tokens))::int name_token_overlap, len(list_intersect(q.address_tokens, t.address_tokens))::int address_token_overlap,
  len(list_intersect(q.digit_tokens, t.digit_tokens))::int digit_overlap, {_jac('digit_tokens')} digit_jaccard,
  {_ratio('name_norm')} name_length_ratio, {_ratio('address_norm')} address_length_ratio, (t.address_norm = '')::int target_address_missing
  from cand c join q on q.entity_id = query_id join t on t.entity_id = target_id and t.target_source = c.target_source)
select query_id, target_source, target_id, country, round(block_score, 6) block_score, exact_hits, shape_hits, name_exact, core_name_exact, address_exact,
  round(name_jaro, 6) name_jaro, round(core_name_jaro, 6) core_name_jaro, round(address_jaro, 6) address_jaro, round(name_levenshtein, 6) name_levenshtein,
  round(core_name_levenshtein, 6) core_name_levenshtein, round(address_levenshtein, 6) address_levenshtein, round(name_char_jaccard, 6) name_char_jaccard,
  round(address_char_jaccard, 6) address_char_jaccard, round(name_token_jaccard, 6) name_token_jaccard, round(address_token_jaccard, 6) address_token_jaccard,
  name_token_overlap, address_token_overlap, digit_overlap, round(digit_jaccard, 6) digit_jaccard, round(name_length_ratio, 6) name_length_ratio,
  round(address_length_ratio, 6) address_length_ratio, target_address_missing,
  round(greatest(name_jaro, core_name_jaro, address_jaro), 6) max_field_jaro, round(name_jaro + address_jaro, 6) joint_jaro from f"""

VALIDATE = """with r as (select trim(coalesce(source1_entity_id, ''), ' ') s, coalesce(matched_entity_ids, '') l from train_matches),
i as (select s, trim(x, ' ') x from (select s, unnest(string_split(l, ',')) x from r where l <> '')),
need as (select distinct trim(entity_id, ' ') s from train_source1),
known as (select trim(entity_id, ' ') x from train_source2 union select trim(entity_id, ' ') from train_source3),
e as (
  select 'duplicate_row' rule, s e from r group by s having count(*) > 1
  union all select distinct 'duplicate_id', s from (select s, x from i group by s, x having count(*) > 1)
  union all select distinct 'self_match', x from i where x like 'S1-%'
  union all select distinct 'wrong_prefix', s from i where x not like 'S1-%' and x not like 'S2-%' and x not like 'S3-%'
  union all select 'missing_row', s from need where s not in (select s from r)
  union all select distinct 'unknown_row', s from r where s not in (select s from need)
  union all select distinct 'unknown_id', x from i where x not in (select x from known))
select rule, 'error' severity, count(*) n, array_to_string((list(e order by e))[1:5], ' ') examples from e group by rule"""


def _survival() -> str:
    def grams(r: str) -> str:
        text = f"concat_ws(' ', {r}.name_norm, {r}.address_norm)"
        return f"list_distinct(list_transform(range(1, greatest(length({text}) - 4, 0) + 1), lambda k: substr({text}, k, 5)))"

    signed, sets = [], []
    for side, records in (("q", "q"), ("t", "t")):
        for cap in (6, 8, 10, 12):
            signed.append(_signatures(f"{side}{cap}", records, cap))
            sets.append(f"{side}p{cap} as (select entity_id, list(signature) l from {side}{cap}_pair group by all)")
    words = [f"{side}w as (select entity_id, list(signature) l from {side}12_exact group by all)" for side in "qt"]
    joins = " ".join(f"left join qp{c} on qp{c}.entity_id = q.entity_id left join tp{c} on tp{c}.entity_id = t.entity_id" for c in (6, 8, 10, 12))
    hits = ", ".join(f"count(*) filter (len(list_intersect(coalesce(qp{c}.l, []), coalesce(tp{c}.l, []))) > 0) hit_{c}" for c in (6, 8, 10, 12))
    return f"""with {SOURCES}, {TRUTH}, {', '.join(signed + sets + words)}
select len(list_intersect(coalesce(qw.l, []), coalesce(tw.l, [])))::int shared_words, count(*) pairs, count(*) filter (t.address_norm = '') missing_address,
  count(*) filter (len(list_intersect({grams('q')}, {grams('t')})) > 0) shared_ngram, {hits}
from truth join q on q.entity_id = source1_entity_id join t on t.entity_id = target_id
left join qw on qw.entity_id = q.entity_id left join tw on tw.entity_id = t.entity_id {joins} group by 1"""


def oracle_sql() -> dict[str, str]:
    labels = "select trim(coalesce(country, '')) country, count(*) n_rows, count(distinct entity_id) n_distinct, count(*) > 0.05 * (select count(*) from train_source2) heavy from train_source2 group by 1"
    bucket = "(concat('0x', substr(md5(entity_id), 1, 8))::bigint % 100)"
    signed_q, signed_t = f"with {SOURCES}, {_signatures('qs', 'q')}", f"with {SOURCES}, {_signatures('qs', 'q')}, {_signatures('ts', 't')}, {_index()}"
    return {
        "p3_found": f"select country from ({labels}) where heavy",
        "p3_labels": labels,
        "scan_normalize": f"""with {SOURCES}, everyone as (select * from q union all select * from t)
            select target_source, entity_id, country, name_norm, core_name, address_norm, array_to_string(name_tokens, ' ') name_tokens,
            array_to_string(address_tokens, ' ') address_tokens, array_to_string(digit_tokens, ' ') digit_tokens from everyone""",
        "scan_tsv": "select " + ", ".join(f"nullif(regexp_replace({c}, '[\\t\\r\\n]', ' ', 'g'), '') {c}" for c in RECORD_COLUMNS) + " from train_source1",
        "normalize_documents": f"select doc_id, {_norm("coalesce(title, '')")} title_norm, {_norm("coalesce(text, '')")} text_norm from documents",
        "truth_explode": f"with {TRUTH} select * from truth",
        "truth_counts": f"with {SOURCES}, {TRUTH} select entity_id query_id, count(truth.target_id) truth_count from q left join truth on source1_entity_id = entity_id group by all",
        "hash_split": f"with {SOURCES} select entity_id, case when {bucket} < {CONFIG.train_percent} then 'train' else 'validation' end split from q where {bucket} < {CONFIG.train_percent + CONFIG.validation_percent}",
        "signature_exact": f"{signed_q} select entity_id, country, kind, signature from qs_exact",
        "signature_shape": f"{signed_q} select entity_id, country, kind, signature from qs_shape",
        "signature_pair": f"{signed_q} select entity_id, country, kind, signature from qs_pair",
        "signature_df": f"{signed_t} select target_source, country, kind, signature, document_frequency from df",
        "signature_weights": f"{signed_t} select * from idx where kind not in ('pe', 'pt')",
        "candidate_raw": f"{BOTH} select * from raw",
        "candidate_shortlist": f"{BOTH}, {SHORT} select * from short",
        "candidate_topk": f"{CANDIDATES} select query_id, target_source, target_id, round(block_score, 6) block_score, exact_hits, shape_hits, candidate_rank, round(name_jaro, 6) name_jaro, round(address_jaro, 6) address_jaro from cand",
        "candidate_bounded_pairs": f"with {SOURCES}, {_signatures('qs', 'q')}, {_signatures('ts', 't')}, {_index(10)}, {RAW} select * from raw",
        "pair_features": PAIR_FEATURES,
        "pair_labels": f'{SCORED} select query_id, target_source, target_id, "label" from pr',
        "blocking_stats": f"{CANDIDATES} select (select count(*) from q) queries, count(*) candidates, count(distinct query_id) queries_with_candidates, count(*) / (select count(*) from q) average_candidates from cand",
        "blocking_recall": f"""{CANDIDATES}, asked as (select * from truth where source1_entity_id in (select entity_id from lq))
            select count(*) truth_links, count(c.query_id) captured, count(c.query_id) / count(*) recall
            from asked left join cand c on c.query_id = source1_entity_id and c.target_id = asked.target_id""",
        "blocking_recall_stages": _recall_stages(),
        "macro_f05": f"""{SCORED}, per as (select tc.query_id, truth_count, count(pr.query_id) filter (probability >= 0.8) p, coalesce(sum("label") filter (probability >= 0.8), 0) h
            from tc left join pr on pr.query_id = tc.query_id group by all) select count(*) entities, round(avg({ENTITY}), 6) macro_f05 from per""",
        "threshold_sweep": f"{SWEEP} select round(threshold, 6) threshold, round(macro_f05, 6) macro_f05 from sweep",
        "threshold_best": f"{SWEEP} select round(threshold, 6) threshold, round(macro_f05, 6) macro_f05 from sweep order by round(sweep.macro_f05, 9) desc, sweep.threshold limit 1",
        "match_lists": f"""{CANDIDATES} select q.entity_id source1_entity_id, coalesce(string_agg(c.target_id, ',' order by c.target_source, c.target_id)
            filter (round(0.5 * (name_jaro + address_jaro), 9) >= 0.8), '') matched_entity_ids from q left join cand c on c.query_id = q.entity_id group by q.entity_id""",
        "candidate_lists": f"""{CANDIDATES} select q.entity_id source1_entity_id, coalesce(string_agg(c.target_id, ',' order by c.target_source, candidate_rank), '') candidate_entity_ids
            from q left join cand c on c.query_id = q.entity_id group by q.entity_id""",
        "validate_id_lists": VALIDATE,
        "blocking_survival": _survival(),
    }
