"""Registered queries of the operators, each over its whole table, with SQL where it can say it."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dailyfacts.llm import (
    arrow_sequences,
    hilbert_shards,
    language_nb,
    partenum,
    periodic_runs,
    piece_codec,
    posting_lists,
    quality_fm,
    rule_ledger,
    simhash_trie,
    slice_codes,
    source_mix,
    url_rules,
)
from dailyfacts.llm.common import remainder
from dailyfacts.llm.xxhash_sql import xxhash64
from dailyfacts.session import scratch_path

#: Folder of the public tokenizers' files, on every machine.
TOKENIZERS = os.environ.get("TOKENIZERS_DIR", "/opt/tokenizers")

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a function under its name; ``sql`` gives its rows in DuckDB."""

    def register(run):
        QUERIES[run.__name__] = run
        if sql:
            ORACLES[run.__name__] = sql
        return run

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_MEASURED_SQL = r"""
with texts as (select doc_id, coalesce(text, '') as t from documents),
split as (
  select doc_id, t, [x for x in regexp_split_to_array(t, '[\x20\x09-\x0D]+') if x <> ''] as ws,
    [x for x in string_split(t, chr(10)) if regexp_matches(x, '[^\x20\x09-\x0D]')] as ls
  from texts
),
windows as (
  select doc_id, i, array_to_string(ws[i:i + 7], ' ') as w
  from (select doc_id, ws, unnest(range(1, len(ws) - 6)) as i from split where len(ws) >= 8)
),
repeated as (
  select doc_id, i from (select *, count(*) over (partition by doc_id, w) as n from windows) where n > 1
),
covered as (
  select doc_id, sum(least(8, coalesce(after - i, 8))) as n_repeat_words
  from (select *, lead(i) over (partition by doc_id order by i) as after from repeated) group by doc_id
),
measured as (
  select doc_id, len(ws)::bigint as n_words,
    length(array_to_string(ws, ''))::bigint as word_chars,
    length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::bigint as n_symbols,
    (len(ls) - len(list_distinct(ls)))::bigint as n_dup_lines,
    coalesce(n_repeat_words, 0)::bigint as n_repeat_words, len(ls)::bigint as n_lines,
    length(regexp_replace(t, '\P{Lu}', '', 'g'))::bigint as n_capitals
  from split left join covered using (doc_id)
)
"""

_BITS_SQL = " + ".join(
    f"(case when {rule.failed} then {1 << rule.bit} else 0 end)" for rule in rule_ledger.RULES
)


@query(_MEASURED_SQL + f"""
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  n_words < 20 or 100 * n_repeat_words > 30 * n_words as base_failed,
  ({_BITS_SQL}) = 0 as kept, ({_BITS_SQL})::bigint as failed_bits
from measured
""")
def op7_rule_ledger(spark, sf_dir):
    """Rule ledger of every document under the base rules and the production policy."""
    ledger = rule_ledger.rule_ledger(table(spark, sf_dir, "documents"))
    return ledger.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        (~rule_ledger.passes(rule_ledger.BASE_POLICY)).alias("base_failed"),
        rule_ledger.passes(rule_ledger.POLICY).alias("kept"),
        "failed_bits",
    )


@query()
def op9_source_mix(spark, sf_dir):
    """Words that the production mix takes from every document."""
    mixed = source_mix.mix(table(spark, sf_dir, "documents"))
    shards = F.transform("draws", lambda d: d["shard"])
    return mixed.select("doc_id", "size", "source_size", "target", "taken", shards.alias("shards"))


@query()
def op10_hilbert_shards(spark, sf_dir):
    """Shard and slot of every document."""
    ordered = hilbert_shards.hilbert_order(table(spark, sf_dir, "documents"))
    dealt = hilbert_shards.cut_runs(ordered)
    return dealt.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), "place",
    )


@query()
def op1_url_rules(spark, sf_dir):
    """Verdict on every page: listed rules, else rules mined from the labels of all pages and proven."""
    pages = table(spark, sf_dir, "pages")
    mined = url_rules.proven_rules(url_rules.labelled_urls(pages, table(spark, sf_dir, "labels")))
    return url_rules.judge(pages, mined)


@query()
def op2_quality_fm(spark, sf_dir):
    """Quality score of every document; labels of held-out rows are not seen."""
    docs = table(spark, sf_dir, "documents")
    labels = table(spark, sf_dir, "labels").where(remainder(F.col("doc_id"), 3) != 1)
    machine = quality_fm.fit(docs, labels, metadata=["n_chars"])
    return quality_fm.score(docs, machine).select(
        "doc_id", (remainder(F.col("doc_id"), 3) == 1).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


@query()
def op8_language_nb(spark, sf_dir):
    """Language of every document; held-out rows do not train."""
    docs = table(spark, sf_dir, "documents")
    model = language_nb.train(docs.where(remainder(F.col("doc_id"), 4) != 2))
    return language_nb.predict(docs, model).select(
        "doc_id", (remainder(F.col("doc_id"), 4) == 2).alias("held_out"), "lang_pred", "score"
    )


@query()
def op5_posting_lists(spark, sf_dir):
    """The ten nearest others of every hundredth vector."""
    vectors = table(spark, sf_dir, "embeddings")
    index = posting_lists.build(vectors)
    return posting_lists.search(index, vectors, F.col("vec_id") % 100 == 0)


@query()
def op6_arrow_sequences(spark, sf_dir):
    """Where every document's ids are in the sequence files, and their checksum."""
    folder = scratch_path(spark, "sequences")
    docs = table(spark, sf_dir, "documents")
    files = arrow_sequences.write_sequences(docs, folder, f"{TOKENIZERS}/byte_bpe_50k.json")
    return arrow_sequences.read_documents(files, folder).withColumnRenamed("key", "doc_id")


_JACCARD_SQL = rf"""
with recursive split as (
  select doc_id, [x for x in regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'
  ) if x <> ''] as ws from documents
),
sets as materialized (
  select distinct doc_id, hash(s) as h, md5(s) as m from (
    select doc_id, unnest([array_to_string(ws[i + 1:i + {partenum.WORDS}], ' ')
      for i in range(greatest(len(ws) - {partenum.WORDS - 1}, 1))]) as s from split where len(ws) > 0
  )
),
sizes as materialized (select doc_id, count(*) as n from sets group by doc_id),
shared as (
  select x.doc_id as a, y.doc_id as b, count(*) as common from sets x join sets y using (h, m)
  where x.doc_id < y.doc_id group by a, b
),
pairs as materialized (
  select a, b from shared join sizes x on a = x.doc_id join sizes y on b = y.doc_id
  where 100 * common >= {partenum.MINIMUM} * (x.n + y.n - common)
),
links as materialized (
  select a, b from pairs union all select b, a from pairs union all select doc_id, doc_id from documents
),
reached as (
  select a, b from links union select reached.a, links.b from reached join links on reached.b = links.a
)
select a as doc_id, coalesce(any_value(n), 0)::bigint as n_shingles, min(b) as component_id
from reached left join sizes on a = doc_id group by a
"""


@query(_JACCARD_SQL)
def op4_partenum(spark, sf_dir):
    """Shingles and component of every document."""
    return partenum.jaccard_groups(table(spark, sf_dir, "documents"))


@query()
def op3_piece_codec(spark, sf_dir):
    """Piece ids of every document, and whether they decode to its text."""
    return piece_codec.encode(table(spark, sf_dir, "documents"), f"{TOKENIZERS}/piece_bpe_32k.model")


def _codes_sql() -> str:
    """Four rounds over four codebooks, one statement after the other."""
    width = "len(v) // 4"
    steps = [f"""
with kept as materialized (
  select vec_id, label, [cast(floor(1024 * x::double) as bigint) for x in embedding] as v
  from embeddings where embedding is not null
    and len([x for x in embedding if x is null or not isfinite(x)]) = 0
),
parts as materialized (
  select vec_id, p, v[p * ({width}) + 1 : (p + 1) * ({width})] as w from kept, range(4) as r(p)
),
book0 as materialized (
  select p, row_number() over (partition by p order by vec_id) - 1 as e, w as c from parts
  qualify row_number() over (partition by p order by vec_id) <= 256
)"""]
    for i in range(slice_codes.ROUNDS + 1):
        steps.append(f"""
near{i} as materialized (
  select vec_id, p, any_value(w) as w, min(d * 256 + e) as best from (
    select vec_id, p, w, e,
      list_sum([(z[1] - z[2]) * (z[1] - z[2]) for z in list_zip(w, c)])::bigint as d
    from parts join book{i} using (p)
  ) group by vec_id, p
)""")
        if i < slice_codes.ROUNDS:
            steps.append(f"""
book{i + 1} as materialized (
  select p, e, coalesce(m.c, b.c) as c from book{i} b left join (
    select p, e, list((s - ((s % n) + n) % n) // n order by i) as c from (
      select p, best % 256 as e, i, sum(w[i])::bigint as s, count(*) as n
      from near{i}, range(1, 1 + (select max(len(w)) from parts)) as r(i) where i <= len(w) group by all
    ) group by p, e
  ) m using (p, e)
)""")
    last = slice_codes.ROUNDS
    steps.append(f"""
coded as materialized (
  select vec_id, label, string_agg(printf('%02x', best % 256), '' order by p) as code,
    sum(best // 256)::bigint as error
  from near{last} join kept using (vec_id) group by vec_id, label
),
digest as (
  select sha256(string_agg(array_to_string(c, ','), ',' order by p, e)) as codebooks_sha256 from book{last}
)""")
    return ",".join(steps) + """
select vec_id, code, error, (sum(error) over (partition by label))::bigint as label_error, codebooks_sha256
from coded, digest
"""


@query(_codes_sql())
def op11_slice_codes(spark, sf_dir):
    """Codes of all vectors under codebooks of all vectors."""
    return slice_codes.compress(table(spark, sf_dir, "embeddings"))


# Matches of a run come 16 in a row at least: equal windows of 16 words at a distance of its period.
_RUNS_SQL = r"""
with crc as (
  select list(list_reduce(range(8),
    lambda c, i: case when c & 1 = 1 then xor(c >> 1, 3988292384::bigint) else c >> 1 end, n::bigint) order by n) as t
  from range(256) as r(n)
),
hashed as (
  select doc_id, [x for x in regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+') if x <> ''] as ws,
    xor(list_reduce([ascii(c)::bigint for c in string_split(doc_id::varchar, '')],
      lambda a, b: xor(a >> 8, t[(xor(a, b) & 255) + 1]), 4294967295::bigint), 4294967295::bigint) as h
  from documents, crc
),
tails as (
  select doc_id, ws, len(ws) as n, h % 10 = 0 and len(ws) > 0 as planted, (h // 10) % greatest(len(ws), 1) as a, h // 10 as g
  from hashed
),
docs as materialized (
  select doc_id, n, case when planted then
    [ws[(case when i < a then i else a + (i - a) % (1 + (n - a) // (3 + g % 8)) end) + 1] for i in range(n)]
    else ws end as ws
  from tails
),
windows as (
  select doc_id, n, i, sha256(array_to_string(ws[i + 1:i + 16], ' ')) as w
  from (select doc_id, n, ws, unnest(range(n - 15)) as i from docs where n >= 24)
),
pairs as (
  select x.doc_id, x.i, y.i - x.i as q from windows x join windows y using (doc_id, w)
  where y.i > x.i and 3 * (y.i - x.i) <= x.n
),
islands as (
  select doc_id, q, min(i) as start, count(*) + 15 + q as length
  from (select *, i - row_number() over (partition by doc_id, q order by i) as island from pairs)
  group by doc_id, q, island having count(*) + 15 + q >= greatest(24, 3 * q)
),
runs as materialized (
  select doc_id, start, length, min(q) as period from islands group by doc_id, start, length
),
best as (
  select * from runs
  qualify row_number() over (partition by doc_id order by length / period desc, start, period) = 1
),
listed as (
  select doc_id, count(*) as n_runs,
    sha256(string_agg(concat(start, ',', length, ',', period, chr(10)), '' order by start, period)) as runs_sha256
  from runs group by doc_id
),
dropped as (
  select distinct doc_id, unnest(range(start + period, start + length)) as i from runs
),
stay as (
  select doc_id, string_agg(word, ' ' order by i) as body
  from (select doc_id, unnest(range(n)) as i, unnest(ws) as word from docs where doc_id in (select doc_id from runs))
  anti join dropped using (doc_id, i) group by doc_id
)
select doc_id, coalesce(n_runs, 0)::bigint as n_runs, start::bigint as start, length::bigint as length,
  period::bigint as period, (1000 * length // period)::bigint as exponent_milli,
  coalesce(runs_sha256, sha256('')) as runs_sha256, sha256(coalesce(body, array_to_string(ws, ' '))) as collapsed_sha256
from docs left join listed using (doc_id) left join best using (doc_id) left join stay using (doc_id)
"""


@query(_RUNS_SQL)
def op12_periodic_runs(spark, sf_dir):
    """Runs of every document, with planted tails, and its words without repeated roots."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    return periodic_runs.run_digests(table(spark, sf_dir, "documents"), h=h)


_BIT_COUNTS = ", ".join(f"sum((h // {1 << b}::uhugeint) % 2)::bigint as b{b}" for b in range(64))
# As a signed number, so that the highest bit counts negative.
_PRINT = " + ".join(f"case when 2 * b{b} > n then {-(1 << 63) if b == 63 else 1 << b}::hugeint else 0 end" for b in range(64))
_PRINTS_SQL = rf"""
with recursive split as (
  select doc_id, [x for x in regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'
  ) if x <> ''] as ws from documents
),
shingles as materialized (
  select doc_id, unnest([array_to_string(ws[i + 1:i + 3], ' ') for i in range(greatest(len(ws) - 2, 1))]) as s
  from split where len(ws) > 0
),
distinct_shingles as (select distinct s from shingles),
hashed as materialized ({xxhash64("distinct_shingles", simhash_trie.SEED)}),
counted as (select doc_id, count(*) as n, {_BIT_COUNTS} from shingles join hashed using (s) group by doc_id),
printed as materialized (
  select doc_id, coalesce(p, 0)::bigint as p from split left join (select doc_id, {_PRINT} as p from counted) using (doc_id)
),
prints as (select distinct p from printed),
links as materialized (
  select x.p as a, y.p as b from prints x join prints y on bit_count(xor(x.p, y.p)) <= {simhash_trie.MOST}
),
reached as (
  select a, b from links union select reached.a, links.b from reached join links on reached.b = links.a
),
labelled as (
  select a as p, min(doc_id) as component_id from reached join printed on b = printed.p group by a
)
select doc_id, printf('%016x', p) as fingerprint, component_id from printed join labelled using (p)
"""


@query(_PRINTS_SQL)
def op13_simhash_trie(spark, sf_dir):
    """Fingerprint and component of every document."""
    return simhash_trie.simhash_groups(table(spark, sf_dir, "documents"))
