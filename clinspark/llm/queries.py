"""The registered queries of this package, and their DuckDB counterparts where SQL has one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clinspark.llm import (
    exact_dedup,
    fill_middle,
    language,
    licenses,
    mixing,
    neighbours,
    packing,
    pieces,
    prefix_trie,
    quality_rules,
    repeats,
    simhash,
    token_files,
)
from clinspark.llm.common import held_out

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(build):
        QUERIES[name] = build
        if sql is not None:
            ORACLES[name] = sql
        return build

    return register


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


KEEP_SCORE = 0.3


@query("op1_quality_rules")
def quality_query(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents")
    model = quality_rules.fit(docs, _table(spark, folder, "labels"))
    return quality_rules.scored(docs, model).select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= KEEP_SCORE).cast("int").alias("predicted"),
    )


@query(
    "op2_exact_dedup",
    r"""
    with t as (
        select doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') as norm from documents
    )
    select doc_id,
           min(doc_id) over same as keep_id,
           count(*) over same as group_size,
           doc_id = min(doc_id) over same as kept,
           sha256(norm) as text_sha256
    from t window same as (partition by norm)
    """,
)
def exact_dedup_query(spark: SparkSession, folder: str) -> DataFrame:
    return exact_dedup.duplicates(_table(spark, folder, "documents"))


MIX_SQL = r"""
    sized as (
        select *, cast(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) as bigint) as size,
               md5('mix:' || coalesce(cast(doc_id as varchar), '') || ':' || md5(coalesce(text, ''))) as key
        from INPUT
    ),
    sources as (
        select source, sum(size) as source_size, row_number() over (order by source nulls last) as source_no
        from sized group by source
    ),
    weighed as (
        select *, [1, 2, 3][(source_no - 1) % 3 + 1] as weight, source_size * 3 as most from sources
    ),
    ranked as (
        select *, sum(source_size) over () - coalesce(sum(most) over earlier, 0) as left_words,
               sum(weight) over () - coalesce(sum(weight) over earlier, 0) as left_weight
        from weighed
        window earlier as (order by most / weight, source_no rows between unbounded preceding and 1 preceding)
    ),
    aims as (
        select source, source_size,
               case when most * left_weight <= left_words * weight then cast(most as double)
                    else cast(weight * max(left_words) filter (most * left_weight > left_words * weight) over ()
                              as double)
                         / max(left_weight) filter (most * left_weight > left_words * weight) over () end as target
        from ranked
    ),
    placed as (
        select sized.*, source_size, target, floor(target / nullif(source_size, 0)) as passes,
               coalesce(sum(size) over (partition by sized.source order by key
                                        rows between unbounded preceding and 1 preceding), 0) + size / 2 as middle
        from sized join aims on sized.source is not distinct from aims.source
    ),
    mix as (
        select *, cast(coalesce(passes, 0)
                       + case when middle < target - coalesce(passes, 0) * source_size then 1 else 0 end
                       as bigint) as copies
        from placed
    )
"""


@query(
    "op3_source_mix",
    "with "
    + MIX_SQL.replace("INPUT", "documents")
    + """
    select doc_id, size, cast(source_size as bigint) as source_size, target, copies, size * copies as taken from mix
    """,
)
def source_mix_query(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mix(_table(spark, folder, "documents"))


@query("op4_simhash")
def simhash_query(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.near_groups(_table(spark, folder, "documents"), shingle_words=3, radius=2)


@query("op5_token_files")
def token_files_query(spark: SparkSession, folder: str) -> DataFrame:
    import public_tokenizers

    tokenizer = public_tokenizers.path("byte_bpe_50k.json")
    manifest, by_rank = token_files.write(_table(spark, folder, "documents"), tokenizer, end_id=0)
    return token_files.read(manifest, by_rank)


@query("op7_sentencepiece")
def pieces_query(spark: SparkSession, folder: str) -> DataFrame:
    import public_tokenizers

    model = public_tokenizers.path("piece_bpe_32k.model")
    return pieces.digests(pieces.encode(_table(spark, folder, "documents"), model))


NEIGHBOUR_FACTOR = 1.2


@query("op6_vantage_neighbours")
def neighbours_query(spark: SparkSession, folder: str) -> DataFrame:
    embeddings = _table(spark, folder, "embeddings")
    return neighbours.nearest(embeddings, F.col("vec_id") % 20 == 0, k=20, factor=NEIGHBOUR_FACTOR)


@query("op8_language")
def language_query(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents")
    return language.predict(docs, language.learn(docs)).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score"
    )


@query("op9_licenses")
def licenses_query(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents")
    return licenses.scan(docs, licenses.fit(docs))


@query("op10_repeats")
def repeats_query(spark: SparkSession, folder: str) -> DataFrame:
    return repeats.passages(_table(spark, folder, "documents"))


@query(
    "op13_fill_middle",
    r"""
    with units as (
        select doc_id, coalesce(text, '') as text, sha256('1:' || cast(doc_id as varchar)) as hex,
               regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') as unit
        from documents
    ),
    drawn as (
        select doc_id, text, unit, len(unit) as n,
               ('0x' || substr(hex, 1, 8))::bigint % (len(unit) + 1) as one,
               ('0x' || substr(hex, 9, 8))::bigint % (len(unit) + 1) as two,
               case when text = '' or contains(text, '<P>') or contains(text, '<S>') or contains(text, '<M>')
                         or ('0x' || substr(hex, 17, 8))::bigint % 100 >= 90 then 'plain'
                    when ('0x' || substr(hex, 25, 8))::bigint % 100 < 20 then 'spm' else 'psm' end as form
        from units
    ),
    parts as (
        select doc_id, text, n, form,
               array_to_string(unit[:least(one, two)], '') as prefix,
               array_to_string(unit[least(one, two) + 1:greatest(one, two)], '') as middle,
               array_to_string(unit[greatest(one, two) + 1:], '') as suffix
        from drawn
    )
    select doc_id, n, form,
           case when form <> 'plain' then length(prefix) end as prefix_chars,
           case when form <> 'plain' then length(middle) end as middle_chars,
           sha256(case form when 'plain' then text
                            when 'psm' then '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                            else '<S>' || suffix || '<P>' || prefix || '<M>' || middle end) as output_sha256,
           sha256(text) as restored_sha256
    from parts
    """,
)
def fill_middle_query(spark: SparkSession, folder: str) -> DataFrame:
    return fill_middle.transform(_table(spark, folder, "documents")).select(
        "doc_id",
        "n",
        "form",
        "prefix_chars",
        "middle_chars",
        F.sha2(F.col("output"), 256).alias("output_sha256"),
        F.sha2(fill_middle.restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"),
    )


@query("op11_packing")
def packing_query(spark: SparkSession, folder: str) -> DataFrame:
    import public_tokenizers

    return packing.pack(_table(spark, folder, "documents"), public_tokenizers.path("word_bpe_49k.json"), end_id=2)


# The checksum of a decimal number, bit by bit: DuckDB has no function for it.
CRC32_SQL = """
    xor(4294967295, list_reduce(
        list_prepend(4294967295::ubigint, flatten(list_transform(string_split(conv_id::varchar, ''),
            lambda c: [ascii(c)::ubigint + 4294967296, 0, 0, 0, 0, 0, 0, 0, 0]))),
        lambda crc, step: case when step > 0 then xor(crc, step - 4294967296)
                               else xor(crc >> 1, 3988292384 * (crc & 1)) end))
"""


@query(
    "op12_prefix_trie",
    f"""
    with t as (
        select conv_id, coalesce(role, '') as role, coalesce(text, '') as text,
               row_number() over (partition by conv_id order by turn nulls first,
                   sha256(length(coalesce(role, ''))::varchar || ':' || coalesce(role, '') || coalesce(text, ''))) as rank
        from conversations where conv_id is not null
    ),
    convs as (
        select conv_id, count(*) as turns, conv_id - conv_id % 100 as base, {CRC32_SQL} % 6 as h from t group by conv_id
    ),
    sized as (
        select c.*, least(c.h, coalesce(b.turns, 0)) as shared from convs c left join convs b on c.base = b.conv_id
    ),
    rebuilt as (
        select s.conv_id, cast(shared + rank - h as bigint) as depth, role, text
        from sized s join t on t.conv_id = s.conv_id where rank > h
        union all
        select s.conv_id, rank, role, text from sized s join t on t.conv_id = s.base where rank <= h
    ),
    paths as (
        select conv_id, depth, text,
               sha256(string_agg(sha256(role || chr(31) || text), ',') over (partition by conv_id order by depth)) as key,
               coalesce(sha256(string_agg(sha256(role || chr(31) || text), ',') over (
                   partition by conv_id order by depth rows between unbounded preceding and 1 preceding)), '') as parent
        from rebuilt
        union all
        select conv_id, 0, '', '', null from convs
    ),
    nodes as (
        select key, min(parent) as parent, min(depth) as depth, min(conv_id) as conv_id, count(*) as n_convs,
               (count(*) - 1) * length(min(text)) as saved
        from paths group by key
    ),
    family as (select parent as key, count(*) as n_children from nodes where parent is not null group by parent),
    subtree as (
        select p.key, sum(case when f.key is null then 1 else 0 end) as n_leaves, sum(n.saved) as saved_tokens
        from nodes n join paths p on p.conv_id = n.conv_id and p.depth <= n.depth left join family f on f.key = n.key
        group by p.key
    ),
    ends as (
        select key, string_agg(conv_id::varchar, ',' order by conv_id) as ids
        from paths p where depth = (select max(depth) from paths q where q.conv_id = p.conv_id) group by key
    )
    select n.conv_id, n.depth, u.conv_id as parent_conv_id, n.n_convs, coalesce(n_children, 0) as n_children,
           cast(n_leaves as bigint) as n_leaves, cast(saved_tokens as bigint) as saved_tokens,
           sha256(coalesce(ids, '')) as ends_sha256
    from nodes n join subtree s on s.key = n.key left join nodes u on u.key = n.parent
         left join family f on f.key = n.key left join ends e on e.key = n.key
    """,
)
def prefix_trie_query(spark: SparkSession, folder: str) -> DataFrame:
    return prefix_trie.trie(_table(spark, folder, "conversations"))
