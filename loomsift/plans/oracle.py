"""SQL with the results of the queries, for an engine that reads the same tables."""

from __future__ import annotations

from loomsift.canonical import CANONICAL, LOOKUP, PERCENT, PHONE, TITLE, YES_NO, header_key
from loomsift.plans.queries import BACKFILL, PARSED, PIVOT, SHOWN

_WS = r"[\t\n\x0B\f\r \x{00a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}\x{feff}]+"


def _squeeze(c: str) -> str:
    return f"nullif(trim(regexp_replace({c}, '{_WS}', ' ', 'g')), '')"


def _null_like(c: str) -> str:
    return f"(case when {_squeeze(c)} is null or lower({_squeeze(c)}) = 'null' then null else {c} end)"


def _title(c: str) -> str:
    return f"array_to_string(list_transform(string_split(lower({_squeeze(c)}), ' '), lambda w: upper(w[1]) || w[2:]), ' ')"


def _coded(c: str, codes: dict[str, str]) -> str:
    return "(case " + " ".join(f"when lower({_squeeze(c)}) in ({v}) then '{k}'" for k, v in codes.items()) + f" else {_title(c)} end)"


def _yes_no(c: str) -> str:
    return _coded(c, {"Yes": "'y','yes','true','1'", "No": "'n','no','false','0'"})


def _phone(c: str) -> str:
    s = _squeeze(c)
    d = f"regexp_replace(regexp_replace({s}, '[^0-9+]', '', 'g'), '^\\+', '')"
    e = f"(case when {d} like '0%' then '254' || {d}[2:] when regexp_matches({d}, '^[71][0-9]{{8}}$') then '254' || {d} else {d} end)"
    return f"(case when regexp_matches({e}, '^254[0-9]{{9}}$') then '+' || {e} else {s} end)"


def _digits(c: str) -> str:
    return f"coalesce(nullif(regexp_replace({_squeeze(c)}, '[^0-9]', '', 'g'), ''), {_squeeze(c)})"


def _percent(c: str) -> str:
    return f"trim(regexp_replace({_squeeze(c)}, '^([^%]*)%', '\\1'))"


def _norm(c: str) -> str:
    return f"trim(regexp_replace(lower({c}), '[^a-z0-9]+', ' ', 'g'))"


def _values(rows: list[tuple], names: str) -> str:
    quote = lambda v: str(v) if isinstance(v, int) else "'" + v.replace("'", "''") + "'"
    return "(values " + ", ".join("(" + ", ".join(map(quote, r)) + ")" for r in rows) + f") as {names}"


def _select(fields: dict[str, str]) -> str:
    return "select id, " + ", ".join(f"{e} as {n}" for n, e in fields.items()) + " from participants"


_ALIAS = _values(list(LOOKUP.items()), "a(norm, field)")
_FIELDS = _values([(f, header_key(f), i) for i, f in enumerate(CANONICAL)], "f(field, fnorm, ordinal)")
_SCORE = "(1.0::double - levenshtein(norm, fnorm)::double / greatest(length(norm), length(fnorm), 1))"
_BAG = "from_json(extra_json, '\"MAP(VARCHAR, VARCHAR)\"')"
_DUPS = "a.run_id = b.run_id and a.drive_file_id = b.drive_file_id and a.status = b.status and a.rows_extracted = b.rows_extracted and a.id > b.id"
_OLD = f"ingested_at < timestamptz '{PIVOT}+00'"
_VALID = "(select p.* from participants p join raw_records r using (drive_file_id, source_row_number) where r.source_row_number > 0)"


def _hash_sql() -> str:
    """The 53-bit hash spelled out with unsigned arithmetic."""
    low = "4294967295"
    mul = lambda x, k: f"((({x})::hugeint * {k}) & {low}::hugeint)::ubigint"
    fold = lambda seed, k: f"list_reduce(list_prepend({seed}::ubigint, codes), lambda h, c: ((xor(h, c)::hugeint * {k}) & {low}::hugeint)::ubigint)"
    return f"""
with t as (select c_custkey, 'google_drive|people.csv|[' || case when c_custkey % 5 = 0 then '["Balance","' || printf('%.2f', c_acctbal) || '"],["Name","' || c_name || '"]]'
  else '["Balance","' || printf('%.2f', c_acctbal) || '"],["Name","' || c_name || '"],["Nation","' || c_nationkey || '"]]' end as txt from customer),
u as (select c_custkey, list_transform(string_split(txt, ''), lambda c: unicode(c)::ubigint) as codes from t),
v as (select c_custkey, {fold(0xDEADBEEF, 2654435761)} as a, {fold(0x41C6CE57, 1597334677)} as b from u),
w as (select c_custkey, xor({mul("xor(a, a >> 16)", 2246822507)}, {mul("xor(b, b >> 13)", 3266489909)}) as a2, b from v),
x as (select c_custkey, a2, xor({mul("xor(b, b >> 16)", 2246822507)}, {mul("xor(a2, a2 >> 13)", 3266489909)}) as b2 from w)
select c_custkey, 'r' || lower(to_hex(((b2 & 2097151::ubigint)::hugeint * 4294967296 + a2)::ubigint)) as row_hash from x"""


def _clean_sql(field: str) -> str:
    """The cleaned form of a field; null-like texts become null first."""
    if field in TITLE:
        shown = _title(field)
    elif field in YES_NO:
        shown = _yes_no(field)
    elif field in PHONE:
        shown = _phone(field)
    elif field in PERCENT:
        shown = _percent(field)
    elif field == "gender":
        shown = _coded("gender", {"Male": "'m','male','man'", "Female": "'f','female','woman'"})
    elif field == "email":
        shown = f"lower({_squeeze('email')})"
    else:
        shown = _digits(field) if field == "national_id" else _squeeze(field)
    return f"case when {_null_like(field)} is null then null else {shown} end"


_DELIMITERS = (",", ";", chr(9), "|")


def _bare(t: str, d: str) -> str:
    """A record without its quoted cells: a quote counts only as the first character of a cell."""
    return f"""regexp_replace({t}, '(^|[{d}])"(?:[^"]|"")*"[^{d}]*', '\\1', 'g')"""


def _open(t: str, d: str) -> str:
    return f"""regexp_matches({_bare(t, d)}, '(^|[{d}])"')"""


def _count(t: str, d: str) -> str:
    return f"(length({_bare(t, d)}) - length(replace({_bare(t, d)}, '{d}', '')) + 1)"


def _heads() -> str:
    """``drive_file_id``, ``t``, cells ``n`` and delimiter ``k`` of each header record."""
    seen = ", ".join(f"case when {_open('t', d)} then 0 else {_count('t', d)} end as n{i}" for i, d in enumerate(_DELIMITERS))
    which = "case " + " ".join(f"when n{i} = greatest(n0, n1, n2, n3) then {i}" for i in range(4)) + " end as k"
    texts = "select drive_file_id, case when left(min(raw_text), 1) = chr(65279) then substr(min(raw_text), 2) else min(raw_text) end as t from raw_records where source_row_number = 0 group by 1"
    return f"(select drive_file_id, t, greatest(n0, n1, n2, n3) as n, {which} from (select drive_file_id, t, {seen} from ({texts}) h) c)"


def _seen() -> str:
    """Rows of participants that the valid records make, with the fields that their file's header names."""
    cells = "string_split(t, case k " + " ".join(f"when {i} then '{d}'" for i, d in enumerate(_DELIMITERS)) + " end)"
    fields = f"select drive_file_id, list(field) as fields from (select drive_file_id, unnest({cells}) as cell from {_heads()} w) u join {_ALIAS} on a.norm = {_norm('cell')} group by 1"
    shown = ", ".join(f"case when list_contains(fields, '{c}') then t.{c} end as {c}" for c in CANONICAL)
    return f"(select t.drive_file_id, t.source_row_number, {shown} from {_VALID} t join ({fields}) f using (drive_file_id))"


def _inserted() -> str:
    """Rows that a load inserts: of equal ones of one file name the first."""
    numbered = f"row_number() over (partition by coalesce(s.source_system, ''), coalesce(s.file_name, ''), {', '.join(f't.{c}' for c in CANONICAL)} order by coalesce(s.file_name, ''), t.drive_file_id, t.source_row_number) as rn"
    return f"(select * from (select t.*, {numbered} from {_seen()} t join drive_file_state s using (drive_file_id)) where rn = 1)"


def _ragged_sql() -> str:
    by = lambda f: "case k " + " ".join(f"when {i} then {f('r.t', d)}" for i, d in enumerate(_DELIMITERS)) + " end"
    rows = "select drive_file_id, coalesce(raw_text, '') as t from raw_records where source_row_number <> 0"
    return f"select r.drive_file_id, count(*) filter (where w.n is null or (not {by(_open)} and {by(_count)} <> w.n)) as ragged, count(*) as records from ({rows}) r left join {_heads()} w using (drive_file_id) group by 1"


def oracle_sql() -> dict[str, str]:
    keys = ", ".join(f"'{k}'" for k in BACKFILL)
    has = f"len(list_filter(map_keys(bag), lambda k: k in ({keys}))) > 0"
    trimmed = lambda c: f"{_squeeze(_null_like(c))} as {c}"
    return {
        "ext_filter": "select drive_file_id, lower(string_split(file_name, '.')[-1]) as ext from drive_file_state where lower(string_split(file_name, '.')[-1]) in ('csv', 'xlsx')",
        "first_parents": "select drive_file_id, nullif(parent_folder_id, '') as parent from drive_file_state",
        "sources_union": "select c_custkey::varchar as id, c_name as name, 'google_drive' as source_system, 1 as n_parents, c_nationkey::varchar as parent, null::varchar as mimeType from customer union all select s_suppkey::varchar, s_name, 'microsoft_onedrive', case when s_nationkey % 2 = 0 then 1 else 0 end, case when s_nationkey % 2 = 0 then s_nationkey::varchar end, 'text/csv' from supplier",
        "one_file": "select drive_file_id as id, file_name as name from drive_file_state order by file_name nulls first, drive_file_id limit 1",
        "key_union": f"with k as (select drive_file_id as file, source_row_number as row_no, list_sort(map_keys({_BAG})) as ks from participants), e as (select file, row_no, unnest(ks) as key, unnest(range(len(ks))) as pos from k), m as (select file, key, min(row_no * 1000 + pos) as seen from e group by 1, 2) select file, key, row_number() over (partition by file order by seen)::int as place from m",
        "byte_ranges": "with d as (select doc_id, coalesce(n_chars, 0)::bigint as size, doc_id % 7 = 0 as whole from documents), r as (select doc_id, size, whole, unnest(range(0, size, 100)) as first_byte from d where size > 0 and not whole) select doc_id, first_byte, least(first_byte + 100, size) - 1 as last_byte from r union all select doc_id, 0, size - 1 from d where size > 0 and whole",
        "byte_frontier": "select doc_id, coalesce(sum(coalesce(n_chars, 0)) over (partition by source order by seq_no, doc_id rows between unbounded preceding and 1 preceding), 0)::bigint as next_offset from documents",
        "url_encoded": "select p_partkey, replace(p_name, ' ', '%20') || '%20(%C3%BC%2F1)~' as encoded from part",
        "normalize_header": f"select drive_file_id, col_no, {_norm('raw_column_name')} as norm from file_headers",
        "trim_all": _select({c: _squeeze(c) for c in ("village", "ward", "remarks")}),
        "title_case": _select({c: _title(c) for c in ("county", "ward", "role", "state_department")}),
        "gender_map": _select({"gender": _coded("gender", {"Male": "'m','male','man'", "Female": "'f','female','woman'"})}),
        "yes_no_map": _select({c: _yes_no(c) for c in ("disability", "follow_up_consent", "internet_access")}),
        "email_lower": _select({"email": f"lower({_squeeze('email')})"}),
        "phone_normalize": _select({c: _phone(c) for c in ("phone_number", "trainer_phone")}),
        "digits_only": _select({"national_id": _digits("national_id")}),
        "percent_clean": _select({c: _percent(c) for c in ("quiz_average", "percent_complete")}),
        "null_likes": _select({c: _null_like(c) for c in ("remarks", "email", "national_id")}),
        "date_clean": "select o_orderkey, case when o_orderkey % 6 = 5 then 'on request' else strftime(o_orderdate, '%Y-%m-%d') end as cleaned from orders",
        "error_texts": "with t as (select id, nullif(error_message, '') as m, case when id % 2 = 0 then 'Failed query: x' end as fd, case when id % 3 = 0 then '503' end as code, case when id % 2 = 0 then null when id % 3 = 0 then 'detail' end as said, rows_extracted as n from ingestion_log), u as (select id, n, nullif(concat_ws(' ', m, fd, '(HTTP ' || code || ')'), '') as fetch_text, coalesce(nullif(concat_ws(' — ', m, said), ''), 'unknown error') as db_text from t) select id, fetch_text, db_text, case when n > 0 then db_text || ' (at byte ' || n || ' of 1000)' else db_text end as noted from u",
        "latin1_roundtrip": "select doc_id, text from documents",
        "similarity_score": "select id, floor((1.0::double - levenshtein(normalized_column_name, 'partner')::double / greatest(length(normalized_column_name), 7, 1)) * 100 + 0.5) / 100 as score from unmapped_columns_log",
        "fuzzy_top1": "select id, best_fuzzy_match, best_fuzzy_score::double as best_fuzzy_score from unmapped_columns_log",
        "alias_lookup_join": f"select drive_file_id, col_no, field from (select drive_file_id, col_no, {_norm('raw_column_name')} as n from file_headers) h left join {_ALIAS} on a.norm = h.n",
        "header_counts": f"select drive_file_id, count(field) as mapped, (count(*) - count(field)) as unmapped from (select drive_file_id, {_norm('raw_column_name')} as n from file_headers) h left join {_ALIAS} on a.norm = h.n group by 1",
        "unmapped_names": f"select {_norm('raw_column_name')} as norm from file_headers except select norm from {_ALIAS}",
        "header_order": "select drive_file_id, string_agg(raw_column_name, '|' order by raw_column_name || ',', col_no) as ordered from file_headers group by 1",
        "last_non_null": f"select id, coalesce({_null_like('trainer_phone')}, {_null_like('cdc_phone')}, {_null_like('phone_number')}) as phone from participants",
        "extra_bag": f"select id, e.key as name, e.value as value from (select id, unnest(map_entries({_BAG})) as e from participants) t",
        "backfill_update": f"with b as (select id, {_BAG} as bag from participants) select id, " + ", ".join(f"case when {has} then {_squeeze(f'bag[{chr(39)}{k}{chr(39)}]')} end as {k.lower().replace(' ', '_')}" for k in BACKFILL) + f", (cardinality(bag) - len(list_filter(map_keys(bag), lambda k: k in ({keys}))))::int as left_over from b",
        "schema_migration": "select s_suppkey, s_name as supplier_name, s_nationkey::varchar as s_nationkey, null::varchar as source_system from supplier",
        "csv_roundtrip": "select drive_file_id, source_row_number, " + ", ".join(trimmed(c) for c in PARSED) + f" from {_seen()} t",
        "row_hashes": _hash_sql(),
        "hash_inputs": """select c_custkey, 's|f|[["a","' || c_mktsegment || '"],["b","' || c_name || '"]]' as text from customer""",
        "dedup_first": "select row_hash, id, drive_file_id, source_row_number from (select *, row_number() over (partition by row_hash order by drive_file_id, source_row_number) as rn from participants) t where rn = 1",
        "distinct_rows": "select count(*) as rows_read, count(distinct row_hash) as rows_loaded, count(*) - count(distinct row_hash) as duplicates from participants",
        "insert_ignore": f"select row_hash, min(id) as id from participants n where not ({_OLD}) and not exists (select 1 from participants o where o.row_hash = n.row_hash and o.{_OLD}) group by 1",
        "insert_ignore_count": f"select count(distinct row_hash) as inserted from participants n where not ({_OLD}) and not exists (select 1 from participants o where o.row_hash = n.row_hash and o.{_OLD})",
        "upsert_latest": "with l as (select drive_file_id, arg_max(status, id) as status, max(id) as log_id from ingestion_log where drive_file_id is not null group by 1) select s.drive_file_id, s.last_status as status, 0::bigint as log_id from drive_file_state s where not exists (select 1 from l where l.drive_file_id = s.drive_file_id) union all select * from l",
        "recordset_scan": "select id, run_id, status, rows_extracted::varchar as rows_extracted, error_message, null::varchar as absent from ingestion_log",
        "batch_pack": "with n as (select l_orderkey, row_number() over (order by l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice) as rn from lineitem) select ((rn - 1) // 2000)::bigint as batch, count(*) as n, min(l_orderkey) as first_order, max(l_orderkey) as last_order from n group by 1",
        "row_sequence": "select doc_id, row_number() over (partition by source order by seq_no nulls first, doc_id)::int as seq from documents",
        "row_cap_per_file": "select id, drive_file_id, source_row_number from participants where source_row_number <= 20",
        "dup_self_join_count": f"select count(*) as pairs from ingestion_log a join ingestion_log b on {_DUPS}",
        "delete_duplicates": f"select id, run_id, drive_file_id, status, rows_extracted from ingestion_log a where not exists (select 1 from ingestion_log b where {_DUPS})",
        "null_safe_dups": "select id, drive_file_id, sheet_name, raw_column_name, sample_value from (select *, row_number() over (partition by drive_file_id, sheet_name, raw_column_name order by id) as rn from unmapped_columns_log) t where rn = 1",
        "file_counts": "select source_file, count(*) as n from participants group by 1",
        "topk_files": "select source_file, count(*) as n from participants group by 1 order by n desc, source_file limit 10",
        "conditional_counts": f"select count(*) as n, count(*) filter (where len(list_filter(map_keys({_BAG}), lambda k: k in ({keys}))) > 0) as to_backfill, count(email) as emails from participants",
        "file_running_totals": "with w as (select drive_file_id, ((source_row_number - 1) // 10)::bigint as seq, count(*) as n from participants group by 1, 2) select drive_file_id, seq, sum(n) over (partition by drive_file_id order by seq)::bigint as rows_extracted from w",
        "file_log_summary": "select drive_file_id as file, sum(rows_extracted)::bigint as rows_extracted, sum(coalesce(rows_loaded, 0))::bigint as rows_loaded, case when bool_or(status = 'failed') then 'failed' else 'loaded' end as status, arg_min(error_message, id) filter (where status = 'failed' and error_message is not null) as error_message from ingestion_log where drive_file_id is not null group by 1",
        "exists_union_probe": "select 'participants' as probe, exists (select 1 from participants where partner is null) as present union all select 'ingestion_log', exists (select 1 from ingestion_log where status = 'failed') union all select 'drive_file_state', exists (select 1 from drive_file_state where last_status = 'header_not_detected')",
        "failure_reasons": "select coalesce(error_message, '') as reason, count(*) as n from ingestion_log where status = 'failed' group by 1",
        "degraded_sources": "select s.source_system, 'source_unreachable' as status, arg_min(l.error_message, l.id) as error_message from ingestion_log l join drive_file_state s using (drive_file_id) where l.status = 'failed' and l.error_message is not null and s.source_system is not null group by 1",
        "version_bump": "select 1 + count(*) filter (where rows_loaded > 0) as source_version, count(*) filter (where rows_loaded > 0) > 0 as dirty from ingestion_log",
        "ragged_count": _ragged_sql(),
        "e2e_ingest": f"select drive_file_id, source_row_number, {', '.join(f'{_clean_sql(c)} as {c}' for c in SHOWN)}, true as hashed from {_inserted()} t",
        "load_log": f"with e as (select drive_file_id, count(*)::int as n from {_VALID} t group by 1), l as (select drive_file_id, count(*)::int as n from {_inserted()} t group by 1) select e.drive_file_id, 'loaded' as status, e.n as rows_extracted, coalesce(l.n, 0) as rows_loaded from e left join l using (drive_file_id)",
        "load_state": f"select drive_file_id, coalesce(source_system, '') as source_system, 'loaded' as last_status from drive_file_state where drive_file_id in (select drive_file_id from {_VALID} t)",
        "unmapped_samples": f"with b as (select drive_file_id as file, source_row_number, unnest(map_entries({_BAG})) as e from participants where source_row_number <= 500), v as (select file, source_row_number, e.key as key, {_null_like('e.value')} as v from b) select file, key as raw_column_name, {_norm('key')} as normalized_column_name, left(arg_min(v, source_row_number), 200) as sample_value from v where v is not null group by 1, 2, 3",
        "csv_strict": "select doc_id, coalesce(text, '') as text, coalesce(lang, '') as lang from documents",
        "csv_row_numbers": "select count(*) + 1 as records, count(*) + 1 as numbers, 1 as first, count(*) + 1 as last from orders",
        "workbook_rows": "select n_nationkey::int as key, n_name as nation, 'Key|Nation' as header, 2 as entries from nation",
    }
