"""Scalar functions on whole columns of the driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.registry import oracle_view, query, stamped
from clinspark.functions import codes, dates, numbers, text
from clinspark.functions.similarity import confidence, token_sort_similarity
from clinspark.operators import candidates, domains


@query(
    "person_id_hash",
    """select USUBJID, RFENDTC, @pid(USUBJID) as person_id, @pid(RFENDTC) as date_id from {dm_dirty}""",
)
def person_id_hash(v):
    return v.dm_dirty.select(
        "USUBJID",
        "RFENDTC",
        text.person_id(F.col("USUBJID")).alias("person_id"),
        text.person_id(F.col("RFENDTC")).alias("date_id"),
    )


@query(
    "parse_date_numeric",
    """select o_orderkey, @stamp(m) as parsed from (
           select o_orderkey, timestamp '1960-01-01' + to_microseconds(cast(
               (cast(o_orderkey % 40000 as double) + 0.25 * (o_custkey % 4)) * 86400000000 as bigint)) as m
           from {orders}) x""",
)
def parse_date_numeric(v):
    days = F.expr("cast(o_orderkey % 40000 as double) + cast(0.25 as double) * (o_custkey % 4)")
    return stamped(v.orders.select("o_orderkey", dates.from_day_count(days).alias("parsed")))


@query("parse_date_text", "select o_orderkey, @stamp(@clinical(txt)) as parsed from {date_text}")
def parse_date_text(v):
    return stamped(v.date_text.select("o_orderkey", dates.clinical_date(F.col("txt")).alias("parsed")))


@query("parse_date_lenient", "select o_orderkey, @stamp(@lenient(txt)) as parsed from {date_text}")
def parse_date_lenient(v):
    return stamped(v.date_text.select("o_orderkey", dates.lenient_date(F.col("txt")).alias("parsed")))


@query(
    "parse_date_typed",
    "select event_id, @stamp(ts) as moment, @stamp(cast(cast(ts as date) as timestamp)) as day from {events}",
)
def parse_date_typed(v):
    typed = v.events.select("event_id", "ts", F.to_date("ts").alias("d"))
    return stamped(
        typed.select(
            "event_id",
            dates.clinical_date_of(typed, "ts").alias("moment"),
            dates.clinical_date_of(typed, "d").alias("day"),
        )
    )


@query(
    "date_parts",
    """select o_orderkey, cast(m as date) as d, @stamp(m) as moment, cast(year(m) as bigint) as y,
              cast(month(m) as bigint) as mo, cast(day(m) as bigint) as dy
       from (select o_orderkey, @clinical(txt) as m from {date_text}) x""",
)
def date_parts(v):
    parsed = v.date_text.select("o_orderkey", dates.clinical_date(F.col("txt")).alias("moment"))
    return stamped(
        parsed.select(
            "o_orderkey",
            F.to_date("moment").alias("d"),
            "moment",
            F.year("moment").cast("bigint").alias("y"),
            F.month("moment").cast("bigint").alias("mo"),
            F.dayofmonth("moment").cast("bigint").alias("dy"),
        )
    )


@query(
    "drug_end_fallback",
    """select CMSEQ, cast(@lenient(CMSTDTC) as date) as start_date,
              cast(coalesce(@lenient(CMENDTC), @lenient(CMSTDTC)) as date) as end_date from {cm}""",
)
def drug_end_fallback(v):
    drugs = domains.drug_from_cm(v.cm)
    return drugs.select(
        F.col("_sequence").cast("bigint").alias("CMSEQ"),
        F.col("drug_exposure_start_date").alias("start_date"),
        F.col("drug_exposure_end_date").alias("end_date"),
    )


@query(
    "first_numeric",
    "select p_partkey, coalesce(@number(first_txt), @number(second_txt)) as value from {number_text}",
)
def first_numeric(v):
    return v.number_text.select(
        "p_partkey", numbers.first_number(v.number_text, "first_txt", "absent", "second_txt").alias("value")
    )


@query(
    "coded_term_fallback",
    "select AESEQ, case when trim(AEDECOD) <> '' then AEDECOD else AETERM end as term, AETERM as verbatim from {ae}",
)
def coded_term_fallback(v):
    term = text.coded_or_verbatim(F.col("AEDECOD"), F.col("AETERM"))
    return v.ae.select("AESEQ", term.alias("term"), F.col("AETERM").alias("verbatim"))


@query(
    "code_map",
    """select USUBJID, cast(case SEX when 'M' then 8507 when 'F' then 8532 when 'U' then 8521 else 0 end as bigint)
                  as gender,
              cast(case upper(RACE) when 'WHITE' then 8527 when 'BLACK OR AFRICAN AMERICAN' then 8516
                   when 'ASIAN' then 8515 else 0 end as bigint) as race,
              cast(case upper(ETHNIC) when 'HISPANIC OR LATINO' then 38003563
                   when 'NOT HISPANIC OR LATINO' then 38003564 else 0 end as bigint) as ethnicity
       from {dm}""",
)
def code_map(v):
    return v.dm.select(
        "USUBJID",
        codes.gender_concept(F.col("SEX")).alias("gender"),
        codes.race_concept(F.col("RACE")).alias("race"),
        codes.ethnicity_concept(F.col("ETHNIC")).alias("ethnicity"),
    )


@query("unit_map", "select LBSEQ, LBORRESU as unit, cast(@unit(LBORRESU) as bigint) as unit_concept_id from {lb}")
def unit_map(v):
    return v.lb.select(
        "LBSEQ", F.col("LBORRESU").alias("unit"), codes.unit_concept(F.col("LBORRESU")).alias("unit_concept_id")
    )


@query(
    "type_concept",
    """select o_orderkey, case when target_table = 'condition_occurrence' and dom in ('AE', 'MH') then 32809
                  when target_table = 'drug_exposure' and dom in ('EX', 'CM') then 32809
                  when target_table = 'measurement' and dom in ('LB', 'VS', 'EG') then 32809 end::bigint
                  as type_concept_id
       from (select o_orderkey, target_table,
                    ['AE', 'MH', 'EX', 'CM', 'LB', 'VS', 'EG', 'SV'][cast(o_orderkey % 8 + 1 as int)] as dom
             from {decision_base}) x""",
)
def type_concept(v):
    rows = v.decision_base.select(
        "o_orderkey",
        F.upper("target_table").alias("target_table"),
        F.expr("element_at(array('AE', 'MH', 'EX', 'CM', 'LB', 'VS', 'EG', 'SV'), cast(o_orderkey % 8 + 1 as int))").alias("dom"),
    )
    return codes.with_type_concept(rows, "target_table", "dom").select("o_orderkey", "type_concept_id")


@query(
    "normalize_key",
    """select p_partkey, @key(term) as rule_key, lower(trim(term)) as name_key, @squash(term) as squashed,
              @key(term || ' x') || ' fibrosis strasse' as folded_key
       from {term_text}""",
)
def normalize_key(v):
    term = F.col("term")
    return v.term_text.select(
        "p_partkey",
        text.normalized_key(term).alias("rule_key"),
        text.match_key(term).alias("name_key"),
        text.squashed(term).alias("squashed"),
        text.normalized_key(F.concat(term, F.lit(" x\x1f ﬁbrosis STRAẞE"))).alias("folded_key"),
    )


@query(
    "clinical_tokens",
    "select p_partkey, array_to_string(@tokens(term), '|') as tokens from {term_text}",
)
def clinical_tokens(v):
    tokens = text.clinical_tokens(F.col("term"))
    return v.term_text.select("p_partkey", F.array_join(tokens, "|").alias("tokens"))


@query(
    "informative_tokens",
    """select p_partkey, array_to_string(@informative(t), '|') as informative, @longest(i) as primary_word
       from (select p_partkey, t, @informative(t) as i
             from (select p_partkey, @tokens(term) as t from {term_text}) x) y""",
)
def informative_tokens(v):
    found = text.informative_tokens(text.clinical_tokens(F.col("term")))
    return v.term_text.select("p_partkey", found.alias("i")).select(
        "p_partkey", F.array_join("i", "|").alias("informative"), text.longest_token(F.col("i")).alias("primary_word")
    )


@query(
    "document_tokens",
    """select doc_id, cast(len(t) as bigint) as n_tokens, @longest(i) as primary_word,
              sha256(array_to_string(t, ' ')) as token_hash
       from (select doc_id, t, @informative(t) as i
             from (select doc_id, @tokens(text) as t from {documents}) x) y""",
)
def document_tokens(v):
    """Tokens of whole documents."""
    split = v.documents.select("doc_id", text.clinical_tokens(F.col("text")).alias("t"))
    return split.select(
        "doc_id",
        F.size("t").cast("bigint").alias("n_tokens"),
        text.longest_token(text.informative_tokens(F.col("t"))).alias("primary_word"),
        F.sha2(F.array_join("t", " "), 256).alias("token_hash"),
    )


@query(
    "token_overlap",
    """select p_partkey,
              len(list_intersect(list_distinct(i), list_distinct(c))) / greatest(len(list_distinct(i)), 1)
                  as informative_overlap,
              len(list_intersect(list_distinct(t), list_distinct(c))) / greatest(len(list_distinct(t)), 1)
                  as total_overlap
       from (select p_partkey, t, c, @informative(t) as i
             from (select p.p_partkey, @tokens(s.term) as t, @tokens(p.concept_name) as c
                   from {term_text} s
                   join (select concept_id - 2000000000 as p_partkey, concept_name from {part_concept}) p
                     on p.p_partkey = s.p_partkey) x) y""",
)
def token_overlap(v):
    return candidates.with_overlap(_pairs(v).withColumn("tokens", text.clinical_tokens(F.col("term")))).select(
        "p_partkey", "informative_overlap", "total_overlap"
    )


def _pairs(v):
    names = v.part_concept.select((F.col("concept_id") - 2000000000).alias("p_partkey"), "concept_name")
    return v.term_text.join(names, "p_partkey")


@query(
    "similarity",
    """select a.p_partkey, cast(round_even(200.0 * (length(a.s) - bit_count(list_reduce(
              list_prepend(a.full_mask, a.masks::hugeint[]),
              lambda v, m: ((v + (v & m)) | (v - (v & m))) & a.full_mask)))
              / (length(a.s) + length(a.c)), 0) as bigint) as similarity
       from (select p_partkey, s, c, (1::hugeint << length(s)::hugeint) - 1 as full_mask,
                    list_transform(string_split(c, ''), lambda ch: list_sum(list_transform(range(0, length(s)),
                        lambda i: case when substr(s, (i + 1)::int, 1) = ch then (1::hugeint << i::hugeint)
                                       else 0::hugeint end))) as masks
             from (select s.p_partkey,
                          array_to_string(list_sort(string_split_regex(
                              trim(regexp_replace(lower(s.term), '\\W+', ' ', 'g')), ' ')), ' ') as s,
                          array_to_string(list_sort(string_split_regex(
                              trim(regexp_replace(lower(p.concept_name), '\\W+', ' ', 'g')), ' ')), ' ') as c
                   from {term_text} s
                   join {part_concept} p on p.concept_id - 2000000000 = s.p_partkey) x) a""",
)
def similarity(v):
    return _pairs(v).select("p_partkey", token_sort_similarity("term", "concept_name").alias("similarity"))


CONFIDENCE = """
    select id, round(round_even(case when len(shared) > 0 and (len(ra) = 0 or len(rb) = 0) then 100.0
              else greatest(200.0 * (length(one) - bit_count(list_reduce(list_prepend(full_mask, masks::hugeint[]),
                                lambda v, m: ((v + (v & m)) | (v - (v & m))) & full_mask)))
                                / (length(one) + length(two)),
                            case when base <> '' then 200.0 * length(base) / (length(base) + length(one)) else 0 end,
                            case when base <> '' then 200.0 * length(base) / (length(base) + length(two)) else 0 end)
              end, 0) / 100.0, 2) as confidence
    from (select *, (1::hugeint << length(one)::hugeint) - 1 as full_mask,
                 list_transform(string_split(two, ''), lambda ch: list_sum(list_transform(range(0, length(one)),
                     lambda i: case when substr(one, (i + 1)::int, 1) = ch then (1::hugeint << i::hugeint)
                                    else 0::hugeint end))) as masks
          from (select *, array_to_string(shared, ' ') as base, array_to_string(list_concat(shared, ra), ' ') as one,
                       array_to_string(list_concat(shared, rb), ' ') as two
                from (select id, list_sort(list_filter(ta, lambda x: list_contains(tb, x))) as shared,
                             list_sort(list_filter(ta, lambda x: not list_contains(tb, x))) as ra,
                             list_sort(list_filter(tb, lambda x: not list_contains(ta, x))) as rb
                      from (select id,
                                   list_distinct(string_split_regex(
                                       trim(regexp_replace(lower(a), '\\W+', ' ', 'g')), ' ')) as ta,
                                   list_distinct(string_split_regex(
                                       trim(regexp_replace(lower(b), '\\W+', ' ', 'g')), ' ')) as tb
                            from {PAIRS}) x) y) z) q"""
oracle_view(
    "o_term_name_pairs",
    """select s.p_partkey as id, s.term as a, p.concept_name as b from {term_text} s
       join {part_concept} p on p.concept_id - 2000000000 = s.p_partkey""",
)


@query(
    "confidence",
    "select id as p_partkey, confidence from (" + CONFIDENCE.replace("PAIRS", "o_term_name_pairs") + ") c",
)
def confidence_query(v):
    return _pairs(v).select("p_partkey", confidence("term", "concept_name").alias("confidence"))


@query(
    "vocab_date",
    """select o_orderkey,
              case when regexp_full_match(trim(txt), '\\d{8}') then cast(try_strptime(trim(txt), '%Y%m%d') as date)
                   when regexp_full_match(trim(txt), '\\d{4}-\\d{1,2}-\\d{1,2}') then try_cast(trim(txt) as date) end
                  as d
       from {date_text}""",
)
def vocab_date(v):
    return v.date_text.select("o_orderkey", dates.vocabulary_date(F.col("txt")).alias("d"))


@query(
    "numeric_coercion",
    """select p_partkey, cast(coalesce(@number(first_txt), 0) as bigint) as as_id, @number(second_txt) as as_number
       from (select p_partkey, case when first_txt like '%.5' then '7' else first_txt end as first_txt, second_txt
             from {number_text}) x""",
)
def numeric_coercion(v):
    rows = v.number_text.withColumn("first_txt", F.expr("case when first_txt like '%.5' then '7' else first_txt end"))
    return rows.select(
        "p_partkey",
        numbers.lenient_id(rows, "first_txt").alias("as_id"),
        numbers.number_of(rows, "second_txt").alias("as_number"),
    )


@query(
    "reply_pick",
    """select conv_id, turn, try_cast(nullif(regexp_extract(text, '[0-9]+'), '') as bigint) as picked
       from {conversations}""",
)
def reply_pick(v):
    """First integer of whole conversation turns."""
    return v.conversations.select("conv_id", "turn", text.first_integer(F.col("text")).alias("picked"))
