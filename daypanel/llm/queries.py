"""The numbered queries over the whole tables, and their DuckDB texts where SQL can say the same.

Not in SQL: op3 (a trained classifier), op4 (a JSON parser and levels of turns), op5 and op9 (trained models and corpus
statistics add spans), op12 (eigenvectors). The tests hold those against brute force. The text of op11 knows the markup of
the given pages only: one ``article`` of headings and paragraphs, two kinds of character references; the tests hold other
markup against expected texts.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import (
    chat_format,
    decontaminate,
    html_extract,
    jaccard_join,
    language_id,
    merkle_manifest,
    pii_sanitise,
    quality_ledger,
    secret_scan,
    source_mix,
    substring_dedup,
    suffix_dedup,
    whitening,
)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_quality_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_ledger.digest(_table(spark, sf_dir, "documents"))


def op2_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.digest(_table(spark, sf_dir, "documents"))


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.digest(_table(spark, sf_dir, "documents"))


def op4_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat_format.digest(_table(spark, sf_dir, "conversations"))


def op5_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.digest(_table(spark, sf_dir, "documents"))


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.digest(_table(spark, sf_dir, "documents"))


def op7_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_mix.digest(_table(spark, sf_dir, "documents"))


def op8_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.digest(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op9_pii_sanitise(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii_sanitise.digest(_table(spark, sf_dir, "documents"))


def op10_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.digest(_table(spark, sf_dir, "documents"))


def op11_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.digest(_table(spark, sf_dir, "pages"))


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(_table(spark, sf_dir, "embeddings"))


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle_manifest.digest(_table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_quality_ledger,
        op2_jaccard_join,
        op3_language_id,
        op4_chat_format,
        op5_secret_scan,
        op6_substring_dedup,
        op7_source_mix,
        op8_decontaminate,
        op9_pii_sanitise,
        op10_suffix_dedup,
        op11_html_extract,
        op12_whitening,
        op13_merkle_manifest,
    )
}

_WORD = r"[^\x20\x09-\x0D]+"
_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

_FAILED = " + ".join(f"case when {rule} then {quality_ledger.BITS[name]} else 0 end" for name, rule in quality_ledger.RULES.items())

_OP1 = f"""
with d as (
  select doc_id, row_number() over () r, coalesce(text, '') text from documents
), w as (
  select r, doc_id, text, regexp_extract_all(text, '{_WORD}') w,
    list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '{_WORD}')) lines
  from d
), grams as (
  select r, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] g from w, unnest(range(1, len(w) - 1)) t(i)
), twice as (
  select r, i from grams qualify count(*) over (partition by r, g) > 1
), covered as (
  select r, count(distinct i + j) n from twice, unnest([0, 1, 2]) t(j) group by r
), m as (
  select r, doc_id, cast(len(w) as bigint) n_words,
    cast(coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) as bigint) word_chars,
    cast(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) as bigint) n_symbols,
    cast(len(lines) as bigint) n_lines,
    cast(len(lines) - len(list_distinct(lines)) as bigint) n_dup_lines,
    cast(length(regexp_replace(text, '[^A-Za-z\\x{{80}}-\\x{{10FFFF}}]', '', 'g')) as bigint) n_letters,
    cast(length(regexp_replace(text, '[^A-Z]', '', 'g')) as bigint) n_upper
  from w
), a as (
  select m.*, coalesce(c.n, 0) n_repeat_words from m left join covered c using (r)
), f as (
  select *, cast({_FAILED} as bigint) failed from a
)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  (failed & {quality_ledger.mask_of("base/1")}) <> 0 base_failed,
  (failed & {quality_ledger.mask_of(quality_ledger.POLICY)}) = 0 kept, failed
from f
"""

_OP2 = f"""
with recursive w as (
  select doc_id, regexp_extract_all({_LOWER}, '{_WORD}') w from documents
), s as (
  select distinct doc_id, array_to_string(w[i:i + 4], ' ') s
  from w, unnest(range(1, greatest(len(w) - 3, 2))) t(i) where len(w) > 0
), n as (
  select doc_id, count(*) n from s group by doc_id
), shared as (
  select a.doc_id x, b.doc_id y, count(*) c from s a join s b on a.s = b.s and a.doc_id < b.doc_id group by all
), links as (
  select x, y from shared join n a on a.doc_id = x join n b on b.doc_id = y where 100 * c >= 80 * (a.n + b.n - c)
), both_ways as (
  select x, y from links union all select y, x from links
), reach as (
  select doc_id x, doc_id y from documents union select r.x, l.y from reach r join both_ways l on l.x = r.y
), component as (
  select x, min(y) component_id from reach group by x
), degree as (
  select x, count(*) n_links from both_ways group by x
)
select d.doc_id, coalesce(n.n, 0) n_shingles, c.component_id, coalesce(g.n_links, 0) n_links
from documents d left join n using (doc_id) join component c on c.x = d.doc_id left join degree g on g.x = d.doc_id
"""

_OP6 = f"""
with w as (
  select doc_id, regexp_extract_all(coalesce(text, ''), '{_WORD}') w from documents
), p as (
  select doc_id, i, w[i] word, case when i + 34 <= len(w) then array_to_string(w[i:i + 34], ' ') end key
  from w, unnest(range(1, len(w) + 1)) t(i)
), again as (
  select doc_id, i, word, key is not null and count(*) over (partition by key) > 1 again from p
), gone as (
  select doc_id, i, word, coalesce(i - max(case when again then i end) over (partition by doc_id order by i
    rows between unbounded preceding and current row) < 35, false) gone
  from again
), kept as (
  select doc_id, count(*) n_words, count(*) filter (gone) n_removed,
    coalesce(string_agg(word, ' ' order by i) filter (not gone), '') kept
  from gone group by doc_id
)
select d.doc_id, coalesce(n_words, 0) n_words, coalesce(n_removed, 0) n_removed, sha256(coalesce(kept, '')) kept_sha256
from documents d left join kept using (doc_id)
"""

_ALNUM = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_OP8 = f"""
with b as (
  select cast(item_id as varchar) item, regexp_extract_all({_LOWER}, '{_ALNUM}') w from benchmark
), phrases as (
  select distinct item, least(10, len(w)) n, array_to_string(w[i:i + 9], ' ') phrase
  from b, unnest(range(1, greatest(len(w) - 8, 2))) t(i) where len(w) > 0
), d as (
  select doc_id, regexp_extract_all({_LOWER}, '{_ALNUM}') w from documents
), windows as (
  select doc_id, i, n, array_to_string(w[i:i + n - 1], ' ') phrase
  from d, (select distinct n from phrases) l, unnest(range(1, len(w) - n + 2)) t(i)
), found as (
  select doc_id, i, n, item from windows join phrases using (n, phrase)
), hits as (
  select doc_id, count(distinct i + j) n_hit from found, unnest(range(0, n)) t(j) group by doc_id
), items as (
  select doc_id, count(*) n_items, string_agg(item, ',' order by item) items
  from (select distinct doc_id, item from found where item is not null) group by doc_id
)
select d.doc_id, cast(coalesce(len(w), 0) as bigint) n_words, coalesce(n_hit, 0) n_hit, coalesce(n_items, 0) n_items,
  sha256(coalesce(items, '')) items_sha256, coalesce(n_hit, 0) > 0 contaminated
from d left join hits using (doc_id) left join items using (doc_id)
"""

_OP10 = """
with h as (
  select doc_id, hex(encode(coalesce(text, ''))) h from documents
), p as (
  select doc_id, i, substr(h, 2 * i + 1, 2) byte, case when 2 * i + 200 <= length(h) then hash(substr(h, 2 * i + 1, 200)) end key
  from h, unnest(range(0, length(h) // 2)) t(i)
), again as (
  select doc_id, i, byte, key is not null and row_number() over (partition by key order by doc_id, i) > 1 again from p
), gone as (
  select doc_id, i, byte, coalesce(i - max(case when again then i end) over (partition by doc_id order by i
    rows between unbounded preceding and current row) < 100, false) gone
  from again
), edges as (
  select *, gone and not coalesce(lag(gone) over (partition by doc_id order by i), false) edge from gone
), kept as (
  select doc_id, count(*) n_bytes, count(*) filter (gone) n_removed, count(*) filter (edge) n_spans,
    coalesce(string_agg(byte, '' order by i) filter (not gone), '') kept
  from edges group by doc_id
)
select d.doc_id, coalesce(n_bytes, 0) n_bytes, coalesce(n_removed, 0) n_removed, coalesce(n_spans, 0) n_spans,
  sha256(unhex(coalesce(kept, ''))) kept_sha256
from documents d left join kept using (doc_id)
"""

_OP11 = r"""
with a as (
  select page_id, url, string_split_regex(regexp_extract(coalesce(html, ''), '(?s)<article>(.*?)</article>', 1), '</?(?:p|h1)>') blocks
  from pages
), plain as (
  select page_id, url, list_transform(blocks, lambda b: trim(regexp_replace(regexp_replace(replace(regexp_replace(
    replace(b, '<br>', ' '), '</?b>', '', 'g'), '&quot;', '"'), '&amp;?', '&', 'g'), '\s+', ' ', 'g'))) blocks from a
), t as (
  select page_id, url, coalesce(array_to_string(list_filter(blocks, lambda b: b <> ''), chr(10) || chr(10)), '') text from plain
)
select page_id, url, text, length(text) n_chars from t
"""


def _form(x: str) -> str:
    return f"coalesce(strlen(cast({x} as varchar)) || ':' || cast({x} as varchar), '-')"


def _leaf(n_chars: str) -> str:
    return f"sha256({' || '.join(_form(x) for x in ('doc_id', 'source', 'lang', n_chars, 'text'))})"


_OP13 = f"""
with recursive crc_nibbles as (
  select list_transform(range(16), lambda i: list_reduce([i, 0, 0, 0, 0], lambda c, z: xor(c >> 1, (c & 1) * 3988292384))) t
), d as (
  select doc_id, lang, {_leaf('n_chars')} leaf, {_leaf('n_chars + 1')} other,
    n_chars is not null and doc_id is not null and xor(list_reduce(list_prepend(4294967295, flatten(list_transform(
      string_split(cast(doc_id as varchar), ''), lambda x: [ord(x) & 15, ord(x) >> 4]))),
      lambda c, x: xor(t[(xor(c, x) & 15) + 1], c >> 4)), 4294967295) % 7 = 0 hit
  from documents, crc_nibbles
), leaves as (
  select doc_id, leaf, case when hit then other else leaf end start, dense_rank() over (order by lang nulls first) - 1 tree,
    row_number() over (partition by lang order by doc_id nulls first, leaf) - 1 place
  from d
), trees as (
  select tree, 0 lvl, place, leaf h, count(*) over (partition by tree) n from leaves
  union all
  select tree, lvl + 1, place // 2, sha256(string_agg(h, '' order by place)), (any_value(n) + 1) // 2
  from trees where n > 1 group by tree, lvl, place // 2
), tops as (
  select tree, h subroot, lvl height from trees where n = 1
), upper as (
  select 0 lvl, tree place, subroot h, count(*) over () n from tops
  union all
  select lvl + 1, place // 2, sha256(string_agg(h, '' order by place)), (any_value(n) + 1) // 2
  from upper where n > 1 group by lvl, place // 2
), climb as (
  select doc_id, leaf, tree, place, start folded, '' proof, 0 step, height,
    (select max(lvl) from upper) over_height from leaves join tops using (tree)
  union all
  select doc_id, leaf, c.tree, c.place, case when step < height
      then sha256(case when (c.place >> step) % 2 = 1 then a.h || folded else folded || coalesce(a.h, '') end)
      else sha256(case when (c.tree >> (step - height)) % 2 = 1 then b.h || folded else folded || coalesce(b.h, '') end) end,
    proof || coalesce(a.h, b.h, ''), step + 1, height, over_height
  from climb c
  left join trees a on step < height and a.tree = c.tree and a.lvl = step and a.place = xor(c.place >> step, 1)
  left join upper b on step >= height and b.lvl = step - height and b.place = xor(c.tree >> (step - height), 1)
  where step < height + over_height
)
select doc_id, leaf, subroot, u.h root, sha256(proof) proof_sha256, folded folded_root, folded = u.h verified
from climb join tops using (tree), upper u where step = climb.height + over_height and u.n = 1
"""

ORACLE_SQL: dict[str, str] = {
    "op1_quality_ledger": _OP1,
    "op2_jaccard_join": _OP2,
    "op6_substring_dedup": _OP6,
    "op7_source_mix": source_mix.oracle_sql(),
    "op8_decontaminate": _OP8,
    "op10_suffix_dedup": _OP10,
    "op11_html_extract": _OP11,
    "op13_merkle_manifest": _OP13,
}
