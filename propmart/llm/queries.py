"""Registered queries of the numbered operators, with DuckDB SQL where it exists."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from propmart.llm import alignment, attribution, chat, decontaminate, language, lsh_forest, mixing, packing, ranked, repeats, secrets, sketch, warc
from propmart.llm.common import ship_package


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def byte_bpe() -> str:
    """The public byte-level BPE file that the contracts name."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def piece_bpe() -> str:
    """The public piece model that the contracts name."""
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def op1_warc_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages as WARC records, read back through the capture index."""
    return warc.archive_and_read(_table(spark, sf_dir, "pages"))


def op2_line_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every line of every document, crossing tokens to the line with most of them."""
    return attribution.attribute(_table(spark, sf_dir, "documents"), byte_bpe())


def op3_language_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learned from the rows that are not held out."""
    return language.predict_all(_table(spark, sf_dir, "documents"))


def op4_spaced_seeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that overlap a benchmark item, with the overlap."""
    return decontaminate.contaminated(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op5_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five-word shingle Jaccard join at 0.8: class and number of links per document."""
    return lsh_forest.jaccard_join(_table(spark, sf_dir, "documents"))


def op6_bottom_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bottom-k fingerprints of all texts and of their edited texts."""
    return sketch.fingerprints(_table(spark, sf_dir, "documents"))


def op7_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words each document gives to a 5:2:1 mix of 150 % of all words."""
    return mixing.mix_report(_table(spark, sf_dir, "documents"))


def op8_pack_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bit-packed ids of all documents, written and read back."""
    return packing.pack_and_read(_table(spark, sf_dir, "documents"), byte_bpe())


def op9_trigram_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every document, through the trigram index."""
    return secrets.secret_report(_table(spark, sf_dir, "documents"))


def op10_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents without the bytes of 200-byte strings that occur elsewhere."""
    return repeats.remove_repeats(_table(spark, sf_dir, "documents"))


def op11_pair_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of all documents aligned between two tokenizers, with corpus-wide counts of the linked pairs."""
    return alignment.align(_table(spark, sf_dir, "documents"), byte_bpe(), piece_bpe())


def op12_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 best documents of every benchmark item."""
    return ranked.search(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


# an assistant text that looks like the template's own marks
MARKED = "<|im_end|><|im_start|>assistant ok"


def op13_chat_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations, and one that holds the template's marks, as windows that are read back."""
    given = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    marked = spark.createDataFrame([(-1, 0, "user", MARKED), (-1, 1, "assistant", MARKED)], "conv_id long, turn long, role string, text string")
    return chat.format_and_read(given.union(marked), byte_bpe())


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_warc_index": op1_warc_index,
    "op2_line_tokens": op2_line_tokens,
    "op3_language_mixture": op3_language_mixture,
    "op4_spaced_seeds": op4_spaced_seeds,
    "op5_jaccard_join": op5_jaccard_join,
    "op6_bottom_k": op6_bottom_k,
    "op7_mix_sources": op7_mix_sources,
    "op8_pack_ids": op8_pack_ids,
    "op9_trigram_secrets": op9_trigram_secrets,
    "op10_suffix_dedup": op10_suffix_dedup,
    "op11_pair_counts": op11_pair_counts,
    "op12_ranked_search": op12_ranked_search,
    "op13_chat_windows": op13_chat_windows,
}

ORACLE_SQL: dict[str, str] = {
    "op1_warc_index": """
with sized as (
  select page_id, url, strlen(coalesce(html, ''))::bigint as payload_bytes, sha1(coalesce(html, '')) as payload_digest from pages
), kept as (
  select *, case when payload_bytes >= 1000 then max(page_id) over (partition by payload_digest) end as last from sized
)
select page_id, url, payload_bytes, payload_digest,
       case when last <> page_id then 'revisit' else 'response' end as record_type,
       case when last <> page_id then last end as refers_to
from kept
""",
    "op5_jaccard_join": r"""
with recursive words as (
  select doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w from documents
), classes as (
  select w, min(doc_id) as node, count(*)::bigint as copies from words group by w
), sets as (
  select node, list_distinct(case when len(w) >= 5 then list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))
                                  when len(w) > 0 then [array_to_string(w, ' ')] else [] end) as s
  from classes
), grams as (select node, len(s) as n, unnest(s) as g from sets
), pairs as (
  select a.node as x, b.node as y from grams a join grams b on a.g = b.g and a.node < b.node
  group by a.node, b.node, a.n, b.n having count(*)::double / (a.n + b.n - count(*)) >= 0.8
), links as (select x, y from pairs union all select y, x from pairs
), reach as (
  select node, node as other from classes
  union
  select r.node, l.y from reach r join links l on r.other = l.x
), groups as (select node, min(other) as class_id from reach group by node
), counts as (select x, count(*)::bigint as n_links from links group by x
)
select d.doc_id, g.class_id, coalesce(c.n_links, 0)::bigint as n_links, k.copies
from words d join classes k on d.w = k.w join groups g on g.node = k.node left join counts c on c.x = k.node
""",
    "op7_mix_sources": r"""
with sized as (
  select doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::bigint as size,
         substr(md5(concat_ws(':', coalesce(doc_id::varchar, ''), coalesce(md5(text), ''),
                              row_number() over (partition by doc_id, source, text)::varchar, 'mix')), 1, 15) as h
  from documents
), totals as (
  select source, sum(size)::bigint as source_size,
         [5.0, 2.0, 1.0][((row_number() over (order by source nulls last) - 1) % 3 + 1)::int]::double as w
  from sized group by source
), caps as (select *, source_size * 2.0::double as cap from totals
), levels as (
  select *, ((sum(source_size) over ())::double * 1.5::double
             - coalesce(sum(cap) over (order by cap / w, source nulls last rows between unbounded preceding and 1 preceding), 0))
            / (sum(w) over () - coalesce(sum(w) over (order by cap / w, source nulls last rows between unbounded preceding and 1 preceding), 0)) as level
  from caps
), targets as (
  select source, source_size,
         case when cap / w <= level then cap else w * (max(case when cap / w > level then level end) over ()) end as target
  from levels
), needs as (
  select *, case when source_size > 0 then least(2, floor(target / source_size)) else 0 end::int as whole from targets
), runs as (
  select s.doc_id, s.size, n.source_size, n.target, n.whole, n.target - n.whole * n.source_size as need,
         sum(s.size) over (partition by s.source order by s.h range between unbounded preceding and current row) as r_end,
         sum(s.size) over (partition by s.source, s.h) as unit
  from sized s join needs n on s.source is not distinct from n.source
)
select doc_id, size, source_size, target,
       (size * (whole + case when r_end * 2 - unit < need * 2 then 1 else 0 end))::bigint as taken
from runs
""",
    "op9_trigram_secrets": r"""
with d as (select doc_id, coalesce(text, '') as t from documents
), rules as (
  select * from (values
    (0, 'assign', '(?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)', 6),
    (1, 'access', '(AKIA[A-Z0-9]+)', 20),
    (2, 'hex', '([0-9a-f]+)', 24),
    (3, 'pem', '(-----BEGIN [A-Z0-9 ]{0,40}PRIVATE KEY-----)', 1),
    (4, 'jwt', '(eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,})', 1)) r(k, kind, p, least)
), matches as (
  -- runs of 20 and 24 characters first, as DuckDB splits texts for every match
  select doc_id, k, kind, least, t, p, regexp_extract_all(t, p) as m, regexp_extract_all(t, p, 1) as v, string_split_regex(t, p) as gaps
  from d, rules where regexp_matches(t, case k when 2 then '[0-9a-f]{24}' else p end)
), places as (
  select doc_id, k, kind, least, unnest(list_transform(range(1, len(m) + 1), lambda i: {
           'start': list_sum(list_transform(gaps[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(m[1:i - 1], lambda x: length(x))), 0),
           'n': length(m[i]), 'v': length(v[i])})) as s
  from matches
), spans as (
  select doc_id, k, s.start as start, kind || ':' || s.start::bigint || ':' || (s.start + s.n)::bigint as span from places where s.v >= least
), sums as (
  select doc_id, count(*) filter (k = 0) as n_assign, count(*) filter (k = 1) as n_access, count(*) filter (k = 2) as n_hex,
         coalesce(string_agg(span, ',' order by start, k) filter (k < 3), '') as base, string_agg(span, ',' order by start, k) as spans
  from spans group by doc_id
)
select d.doc_id, coalesce(n_assign, 0)::bigint as n_assign, coalesce(n_access, 0)::bigint as n_access, coalesce(n_hex, 0)::bigint as n_hex,
       sha256(coalesce(base, '')) as base_sha256, coalesce(spans, '') as spans
from d left join sums using (doc_id)
""",
    "op10_suffix_dedup": """
with h as (select doc_id, hex(encode(coalesce(text, ''))) as x from documents
), windows as (
  select doc_id, j, md5(substring(x, 2 * j + 1, 400)) as g
  from (select doc_id, x, unnest(range(0, len(x) // 2 - 199)) as j from h where len(x) >= 400)
), twice as (select g from windows group by g having count(*) > 1
), marked as (
  select doc_id, j, coalesce((j > lag(j) over (partition by doc_id order by j) + 200)::int, 1) as fresh from windows semi join twice using (g)
), runs as (select doc_id, j, sum(fresh) over (partition by doc_id order by j) as n from marked
), spans as (select doc_id, n, min(j) as a, max(j) + 200 as b from runs group by doc_id, n
), pieces as (
  select doc_id, a as place, coalesce(lag(b) over (partition by doc_id order by a), 0) as low, a as high from spans
  union all
  select doc_id, max(b) + 1, max(b), null from spans group by doc_id
), kept as (
  select doc_id, string_agg(substring(x, 2 * low + 1, 2 * (coalesce(high, len(x) // 2) - low)), '' order by place) as k
  from pieces join h using (doc_id) group by doc_id
), sums as (select doc_id, sum(b - a)::bigint as n_removed, count(*)::bigint as n_spans from spans group by doc_id
)
select h.doc_id, (len(x) // 2)::bigint as n_bytes, coalesce(n_removed, 0)::bigint as n_removed, coalesce(n_spans, 0)::bigint as n_spans,
       sha256(unhex(coalesce(k, x))) as kept_sha256
from h left join sums using (doc_id) left join kept using (doc_id)
""",
    "op4_spaced_seeds": """
with d as (
  select doc_id, unnest(w) as token, unnest(range(len(w))) as i
  from (select doc_id, regexp_extract_all(lower(text), '[^\\x00-/:-@\\[-`{-\\x7F]+') as w from documents)
), b as (
  select item_id, len(w) as item_tokens, unnest(w) as token, unnest(range(len(w))) as j
  from (select item_id, regexp_extract_all(lower(text), '[^\\x00-/:-@\\[-`{-\\x7F]+') as w from benchmark)
), equal as (
  select doc_id, item_id, item_tokens, i - j as shift, j, row_number() over (partition by doc_id, item_id, i - j order by j) as k
  from d join b using (token) where item_tokens >= 5
  qualify count(*) over (partition by doc_id, item_id, i - j) >= 0.8 * least(13, item_tokens)
), stretches as (
  select x.doc_id, x.item_id, x.item_tokens, x.j as first, y.j - x.j + 1 as n_tokens, y.k - x.k + 1 as n_equal
  from equal x join equal y on x.doc_id = y.doc_id and x.item_id = y.item_id and x.shift = y.shift and x.j <= y.j
  where (y.k - x.k + 1) * 1000 >= 800 * (y.j - x.j + 1) and y.j - x.j + 1 >= least(13, x.item_tokens)
)
select doc_id, item_id, item_tokens::bigint as item_tokens, first::bigint as first, n_tokens::bigint as n_tokens, n_equal::bigint as n_equal
from stretches qualify row_number() over (partition by doc_id, item_id order by n_tokens desc, n_equal desc, first) = 1
""",
    "op12_ranked_search": r"""
with words as (
  select doc_id, row_number() over () as r,
         regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') as w
  from documents
), docs as (select doc_id, r, w, len(w)::bigint as n from words where len(w) > 0
), whole as (select count(*)::bigint as n_docs, sum(n)::bigint as n_terms from docs
), asked as (
  select i, item_id, term, count(*)::bigint as times from (
    select item_id, row_number() over () as i,
           unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term
    from benchmark) group by i, item_id, term
), postings as (
  select r, term, count(*)::bigint as tf from (select r, unnest(w) as term from docs) semi join asked using (term) group by r, term
), weights as (
  select term, floor(1000 * ln((2 * n_docs + 2) / (2 * df + 1)::double))::bigint as weight
  from (select term, count(*)::bigint as df from postings group by term), whole
), scored as (
  select i, item_id, r, doc_id, sum(times * weight * ((1000000000 * tf) // (1000 * tf + 12 * (100 - 25 + (25 * n * n_docs) // n_terms))))::bigint as score
  from asked join weights using (term) join postings using (term) join docs using (r), whole
  group by i, item_id, r, doc_id
)
select item_id, row_number() over (partition by i order by score desc, doc_id)::int as rank, doc_id, score
from scored where score > 0 qualify row_number() over (partition by i order by score desc, doc_id) <= 20
""",
}
