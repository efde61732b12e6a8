"""Registered queries of the corpus operators, and SQL for those that SQL can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stackweave.llm import chat, common, language, licenses, mixing, negatives, quality, repair, scoring, simhash, suffixes, tiling, toxicity, warc


def op1_mixing(spark: SparkSession, folder: str) -> DataFrame:
    docs = common.documents(spark, folder)
    sizes = docs.select("doc_id", "source", common.word_count(F.col("text")).alias("size"))
    mixed = mixing.mix(common.WorkTable(sizes, "sizes").df)
    return mixing.by_position(mixed.select("doc_id", "size", "source_size", "target", "taken", "position"))


def op2_quality(spark: SparkSession, folder: str) -> DataFrame:
    docs = common.documents(spark, folder)
    counted = common.WorkTable(quality.features(docs.select("doc_id", "text", "lang")).drop("text"), "features").df
    judged = quality.judge(counted, common.table(spark, folder, "labels"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op3_simhash(spark: SparkSession, folder: str) -> DataFrame:
    docs = common.documents(spark, folder)
    found = simhash.near_duplicates(docs)
    return found.withColumn("fingerprint", simhash.hexadecimal(F.col("fingerprint")))


def op4_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = common.documents(spark, folder)
    model = toxicity.train(docs, common.table(spark, folder, "labels"))
    scored = toxicity.score(docs.select("doc_id", "text"), model)
    return scored.select("doc_id", (~common.in_training(F.col("doc_id"))).alias("held_out"), "score", "predicted")


def op5_scoring(spark: SparkSession, folder: str) -> DataFrame:
    docs = common.documents(spark, folder)
    return scoring.score(docs.select("doc_id", "text"), *scoring.learn(docs)).drop("text")


def op6_suffixes(spark: SparkSession, folder: str) -> DataFrame:
    docs = common.documents(spark, folder)
    cut = suffixes.remove_repeats(docs.select("doc_id", "text"))
    return cut.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op7_tiling(spark: SparkSession, folder: str) -> DataFrame:
    return tiling.contaminated(common.documents(spark, folder), common.table(spark, folder, "benchmark"))


def op8_warc(spark: SparkSession, folder: str) -> DataFrame:
    back = warc.round_trip(common.table(spark, folder, "pages"))
    return back.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op9_licenses(spark: SparkSession, folder: str) -> DataFrame:
    docs = common.documents(spark, folder).select("doc_id", "text")
    return licenses.scan(docs, licenses.train(docs)).drop("body")


def op10_language(spark: SparkSession, folder: str) -> DataFrame:
    docs = common.documents(spark, folder)
    judged = language.identify(docs.select("doc_id", "text"), language.train(docs))
    held = ~common.in_training(F.col("doc_id"))
    return judged.select("doc_id", held.alias("held_out"), "lang_pred", "score", "rejected")


def op11_repair(spark: SparkSession, folder: str) -> DataFrame:
    rows = common.table(spark, folder, "conversations")
    return repair.audited(rows, repair.damage(rows))


def op12_negatives(spark: SparkSession, folder: str) -> DataFrame:
    rows = common.table(spark, folder, "embeddings")
    return negatives.mine(negatives.mislabelled(negatives.usable(rows)))


def op13_chat(spark: SparkSession, folder: str) -> DataFrame:
    rows = common.table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    said = "</s>[INST] ok [/INST]"
    planted = spark.createDataFrame([(-1, 0, "user", said), (-1, 1, "assistant", said)], "conv_id long, turn long, role string, text string")
    return chat.read_back(chat.formatted(rows.unionByName(planted)), in_place=True)


QUERIES = {
    "op1_mixing": op1_mixing,
    "op2_quality": op2_quality,
    "op3_simhash": op3_simhash,
    "op4_toxicity": op4_toxicity,
    "op5_scoring": op5_scoring,
    "op6_suffixes": op6_suffixes,
    "op7_tiling": op7_tiling,
    "op8_warc": op8_warc,
    "op9_licenses": op9_licenses,
    "op10_language": op10_language,
    "op11_repair": op11_repair,
    "op12_negatives": op12_negatives,
    "op13_chat": op13_chat,
}

STATEMENTS: dict[str, str] = {
    "op1_mixing": r"""
        with sizes as (
            select doc_id, source, md5(coalesce(doc_id::varchar, '')) as key,
                len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::bigint as size
            from documents
        ), numbered as (
            select source, sum(size)::bigint as source_size, row_number() over (order by source nulls last) - 1 as source_no
            from sizes group by source
        ), weighted as (
            select *, [3, 1, 2][source_no % 3 + 1] as weight, 2 * source_size as most,
                2 * source_size / [3, 1, 2][source_no % 3 + 1] as level
            from numbered
        ), filled as (
            select *, sum(source_size) over () * 1.5::double as budget,
                sum(most) over (order by level, source_no)
                + level * coalesce(sum(weight) over (order by level, source_no rows between 1 following and unbounded following), 0)
                <= sum(source_size) over () * 1.5::double as is_full
            from weighted
        ), aimed as (
            select source, source_no, source_size, case when is_full then most::double
                else (budget - sum(case when is_full then most else 0 end) over ())
                    / sum(case when is_full then 0 else weight end) over () * weight end as target
            from filled
        ), placed as (
            select s.doc_id, s.size, a.*, round(a.target)::bigint as words, (sum(s.size) over (
                partition by a.source_no order by s.key, s.doc_id, s.size rows between unbounded preceding and current row) - s.size)::bigint as start
            from sizes s join aimed a on s.source is not distinct from a.source
        ), cut as (
            select *, greatest(0, least(words - start, size)) + greatest(0, least(words - source_size - start, size)) as taken,
                start / words as share
            from placed
        )
        select doc_id, size, source_size, target, taken::bigint as taken, case when taken > 0 then case source_no % 3
            when 0 then 2.0::double * share / (1.5::double + sqrt(greatest(0.0::double, 2.25::double + -2.0::double * share)))
            when 1 then 2.0::double * share / (0.5::double + sqrt(greatest(0.0::double, 0.25::double + 2.0::double * share)))
            else 2.0::double * share / (1.0::double + sqrt(greatest(0.0::double, 1.0::double + 0.0::double * share))) end end as position
        from cut
    """,
    "op2_quality": r"""
        with split as (
            select doc_id, coalesce(lang, '') as stratum, coalesce(text, '') as text,
                regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as words,
                list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) as lines
            from documents
        ), counted as (
            select *, row_number() over () as place, len(words) as n_words, coalesce(length(array_to_string(words, '')), 0) as word_chars,
                length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) as n_symbols,
                length(text) - length(regexp_replace(text, '\p{Lu}', '', 'g')) as n_capitals,
                len(lines) as n_lines, len(lines) - len(list_distinct(lines)) as n_dup_lines
            from split
        ), windows as (
            select place, unnest(range(1, n_words - 6)) as i, words from counted where n_words >= 8
        ), keyed as (
            select place, i, array_to_string(words[i : i + 7], ' ') as w from windows
        ), again as (
            select place, i from (select *, count(*) over (partition by place, w) as n from keyed) where n > 1
        ), covered as (
            select place, count(distinct k) as n_repeat_words from (select place, unnest(range(i, i + 8)) as k from again) group by place
        ), base as (
            select c.*, coalesce(n_repeat_words, 0) as n_repeat_words,
                n_words < 20 or 100 * coalesce(n_repeat_words, 0) > 30 * n_words as base_failed,
                1000.0::double * n_symbols / greatest(word_chars, 1) as symbols, 1000.0::double * n_capitals / greatest(word_chars, 1) as capitals,
                1000.0::double * n_dup_lines / greatest(n_lines, 1) as dup, 1000.0::double * coalesce(n_repeat_words, 0) / greatest(n_words, 1) as repeats
            from counted c left join covered using (place)
        ), good as (
            select doc_id, min(quality) > 0 as good from labels where quality is not null group by doc_id
        ), known as (
            select stratum, good, unnest([{'rule': 1, 'x': symbols}, {'rule': 2, 'x': capitals}, {'rule': 3, 'x': dup}, {'rule': 4, 'x': repeats}], recursive := true)
            from (select distinct on (doc_id) * from base where not base_failed) join good using (doc_id)
        ), grid as (
            select unnest([5, 10, 15, 20, 30, 40, 50, 75, 100, 150, 200, 300, 400, 500, 700]) as cut
        ), tried as (
            select stratum, rule, cut, count(*) filter (good) as n, count(*) filter (good and x > cut) as k,
                count(*) filter (not good) as bad, count(*) filter (not good and x > cut) as caught
            from known, grid group by all
        ), gained as (
            select *, caught / greatest(bad, 1) - k / n as gain from tried
            where n > 0 and k < n * 0.0125::double and list_sum(list_transform(range(0, k + 1), lambda j: exp(
                lgamma(n + 1) - lgamma(j + 1) - lgamma(n - j + 1) + j * ln(0.0125::double) + (n - j) * ln(0.9875::double))))
                <= 0.05::double / (60 * (select count(distinct stratum) from known))
        ), best as (
            select stratum, rule, max_by(cut, (gain, cut)) as cut from gained where gain > 0 group by all
        ), limits as (
            select stratum, max(cut) filter (rule = 1) as c1, max(cut) filter (rule = 2) as c2, max(cut) filter (rule = 3) as c3, max(cut) filter (rule = 4) as c4
            from best group by stratum
        )
        select doc_id, n_words::bigint as n_words, word_chars::bigint as word_chars, n_symbols::bigint as n_symbols,
            n_dup_lines::bigint as n_dup_lines, n_repeat_words::bigint as n_repeat_words, base_failed,
            not (base_failed or coalesce(symbols > c1, false) or coalesce(capitals > c2, false) or coalesce(dup > c3, false)
                or coalesce(repeats > c4, false)) as kept
        from base left join limits using (stratum)
    """,
    "op8_warc": r"""
        with hashed as (
            select page_id, coalesce(html, '') as html, sha1(coalesce(html, '')) as h from pages
        ), digits as (
            select page_id, html, h, array_to_string(list_transform(range(0, 32), lambda k: substring('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
                (('0x' || substring(h, (k // 8)::int * 10 + 1, 10))::bigint >> (5 * (7 - k % 8))::int & 31)::int + 1, 1)), '') as payload_digest
            from hashed
        ), first as (
            select *, min(page_id) over (partition by h) as first from digits
        )
        select page_id, strlen(html)::bigint as payload_bytes, payload_digest,
            case when page_id = first then 'response' else 'revisit' end as record_type,
            case when page_id = first then null else first end as refers_to
        from first
    """,
    "op11_repair": r"""
        with recursive keyed as (
            select conv_id, turn, coalesce(role, ' ') as role, coalesce(text, ' ') as text,
                coalesce(conv_id::varchar, ' ') || ':' || coalesce(turn::varchar, ' ') as k
            from conversations
        ), coded as (
            select *, xor(4294967295, list_reduce(
                list_concat([4294967295::bigint], list_transform(string_split(k, ''), lambda c: ord(c)::bigint)),
                lambda c, b: list_reduce(list_concat([xor(c, b)], range(8)),
                    lambda x, i: case when x & 1 = 1 then xor(x >> 1, 3988292384) else x >> 1 end))) % 20 as kind
            from keyed
        ), hurt as (
            select conv_id, turn, case when kind = 4 then 'user' else role end as role,
                case kind when 1 then '' when 2 then regexp_replace(text, '[.!?]', '', 'g') else text end as text
            from coded, unnest(range(case when kind = 3 then 2 else 1 end)) where kind <> 0
        ), ordered as (
            select *, row_number() over (partition by conv_id order by turn nulls first, role, sha256(text)) as i from hurt
        ), placed as (
            select *, row_number() over (partition by conv_id, role, text order by i) as again from ordered
        ), flagged as (
            select conv_id, turn, role, text, i, left(role, 1) as initial, case when not regexp_matches(text, '[^\x20\x09-\x0D]') then 'blank'
                when again > 1 then 'duplicate' when not regexp_matches(text, '[.!?][\x20\x09-\x0D]*\z') then 'truncated' else '' end as fault,
                lag(left(role, 1)) over (partition by conv_id order by i) || left(role, 1) as pair
            from placed
        ), counted as (
            select conv_id, coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0)::bigint as gaps, count(*) filter (fault = 'blank') as blank,
                count(*) filter (fault = 'duplicate') as duplicate, count(*) filter (fault = 'truncated') as truncated,
                count(*) filter (pair not in ('su', 'ua', 'au')) as illegal, count(*) as n
            from flagged group by conv_id
        ), moves(s1, edit, initial, s2, cost) as (
            values ('E', 'K', 's', 'S', 0), ('E', 'K', 'u', 'U', 0), ('S', 'K', 'u', 'U', 0), ('A', 'K', 'u', 'U', 0), ('U', 'K', 'a', 'A', 0),
                ('E', 'R', null, 'U', 2), ('S', 'R', null, 'U', 2), ('A', 'R', null, 'U', 2), ('U', 'R', null, 'A', 2),
                ('E', 'D', null, 'E', 3), ('S', 'D', null, 'S', 3), ('U', 'D', null, 'U', 3), ('A', 'D', null, 'A', 3)
        ), added(s1, s2, letters) as (
            values ('E', 'E', ''), ('S', 'S', ''), ('U', 'U', ''), ('A', 'A', ''), ('E', 'U', 'I'), ('S', 'U', 'I'), ('A', 'U', 'I'), ('U', 'A', 'I'),
                ('E', 'A', 'II'), ('S', 'A', 'II')
        ), search(conv_id, i, state, cost, audit) as (
            select conv_id, 0::bigint, s2, 2 * length(letters), letters from counted, added where s1 = 'E'
            union all
            select conv_id, i, state, best.cost, best.audit from (
                select f.conv_id, f.i, a.s2 as state, min({
                    'cost': s.cost + m.cost + 2 * length(a.letters) + case when f.fault = 'truncated' and m.edit <> 'D' then 1 else 0 end,
                    'audit': s.audit || m.edit || a.letters}) as best
                from search s join flagged f on f.conv_id is not distinct from s.conv_id and f.i = s.i + 1
                join moves m on m.s1 = s.state and (m.initial is null or m.initial = f.initial) and (m.edit = 'D' or f.fault not in ('blank', 'duplicate'))
                join added a on a.s1 = m.s2
                group by f.conv_id, f.i, a.s2
            )
        ), best as (
            select c.*, b.best.cost as cost, b.best.audit as audit from counted c join (
                select s.conv_id, min({'cost': s.cost, 'audit': s.audit}) as best
                from search s join counted c on c.conv_id is not distinct from s.conv_id and c.n = s.i
                where s.state in ('E', 'A') group by s.conv_id
            ) b on b.conv_id is not distinct from c.conv_id
        ), letters as (
            select conv_id, p, audit[p] as edit, count(*) filter (audit[p] <> 'I') over (partition by conv_id order by p) as i,
                count(*) filter (audit[p] <> 'D') over (partition by conv_id order by p) as place
            from (select conv_id, audit, unnest(range(1, length(audit) + 1)) as p from best)
        ), laid as (
            select l.*, f.role, f.text, f.initial, max(case when place = 1 and edit = 'K' and initial = 's' then 1 else 0 end) over (partition by l.conv_id) as headed
            from letters l left join flagged f on f.conv_id is not distinct from l.conv_id and f.i = l.i and l.edit <> 'I'
            where l.edit <> 'D'
        ), repaired as (
            select conv_id, string_agg(case when edit = 'K' then role when (place - headed) % 2 = 1 then 'user' else 'assistant' end
                || ':' || coalesce(text, ''), chr(10) order by p) as said
            from laid group by conv_id
        )
        select o.conv_id, coalesce(gaps, 0) as gaps, coalesce(blank, 0) as blank, coalesce(duplicate, 0) as duplicate,
            coalesce(truncated, 0) as truncated, coalesce(illegal, 0) as illegal, coalesce(cost, 0)::bigint as cost, coalesce(audit, '') as audit,
            sha256(coalesce(said, '')) as repaired_sha256
        from (select distinct conv_id from conversations) o left join best b on b.conv_id is not distinct from o.conv_id
            left join repaired r on r.conv_id is not distinct from o.conv_id
    """,
    "op12_negatives": r"""
        with taken as (
            select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
                list_transform(embedding, lambda x: floor(256 * x::double)) as v
            from embeddings where vec_id is not null and label is not null and embedding is not null
                and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
        ), pairs as (
            select a.vec_id as anchor_id, a.label = c.label as same, c.vec_id, list_inner_product(a.v, c.v)::bigint as score
            from taken a join taken c on a.vec_id <> c.vec_id where a.vec_id % 50 = 0
        ), positives as (
            select * from (select *, row_number() over (partition by anchor_id order by score desc, vec_id) as place from pairs where same)
            where place <= 5
        ), banded as (
            select n.anchor_id, p.vec_id as positive_id, n.vec_id as negative_id, p.score as positive_score, n.score as negative_score,
                row_number() over (partition by n.anchor_id, p.vec_id order by n.score desc, n.vec_id)::int as rank
            from positives p join pairs n on n.anchor_id = p.anchor_id and not n.same
                and 50 * p.score <= 100 * n.score and 100 * n.score <= 95 * p.score
        )
        select anchor_id, positive_id, rank, negative_id, positive_score, negative_score from banded where rank <= 3
    """,
    "op13_chat": r"""
        with given as (
            select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
            union all select -1, unnest([0, 1]), unnest(['user', 'assistant']), '</s>[INST] ok [/INST]'
        ), marks as (
            select unnest([chr(92), '[INST]', '[/INST]', '<s>', '</s>', '<|', '|>']) as mark
        ), texts as (
            select distinct role as said from given union select distinct text from given
        ), escaped as (
            select said, length(said) + sum((length(said) - length(replace(said, mark, ''))) // length(mark)) as chars
            from texts, marks group by said
        ), sized as (
            select g.*, case role when 'user' then 15 + t.chars when 'assistant' then 4 + t.chars else 11 + r.chars + t.chars end as chars
            from given g join escaped t on t.said = g.text join escaped r on r.said = g.role
        )
        select conv_id, count(*) as n_turns,
            sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn nulls first, role, text)) as turns_sha256,
            coalesce(sum(length(text)) filter (role = 'assistant'), 0)::bigint as loss_chars,
            sha256(coalesce(string_agg(text, '' order by turn nulls first, role, text) filter (role = 'assistant'), '')) as loss_sha256,
            sum(chars)::bigint as formatted_chars
        from sized group by conv_id
    """,
}
