"""Greedy decoding and error rates."""

from pyspark.sql import functions as F

from checks.registry import check, table
from speechlake.functions.text import character_classes
from speechlake.operators import join as J
from speechlake.operators import score as E
from speechlake.operators import sequence as W
from speechlake.operators.ranking import number_slice
from speechlake.plans.training import score

_SPACE = character_classes()["space"]
_EVENT_ORDER = ["ts", "event_id"]

# The event types as token ids; the first one is the blank.
_TYPES = ["error", "click", "view", "purchase", "signup"]
_ID_SQL = "(list_position(['error', 'click', 'view', 'purchase', 'signup'], event_type) - 1)"
_LETTER_SQL = "substr(event_type, 1, 1)"


def _words_sql(text):
    return f"list_filter(regexp_split_to_array({text}, '[{_SPACE}]+'), lambda w: w <> '')"


def _hour():
    return F.date_trunc("hour", "ts")


def _events(spark, sf):
    """Events of a user on a day are the frames of an utterance."""
    kind = F.array_position(F.array(*[F.lit(t) for t in _TYPES]), F.col("event_type")) - 1
    return table(spark, sf, "events").select(
        "user_id", F.date_format("ts", "yyyy-MM-dd").alias("day"), "ts", "event_id", "event_type", kind.cast("int").alias("token")
    )


@check(
    "w1_argmax_frames",
    "select vec_id, label, list_position(embedding, list_max(embedding)) - 1 as token from embeddings",
)
def argmax_frames(spark, sf):
    return W.argmax_frames(table(spark, sf, "embeddings").select("vec_id", "label", "embedding"), "embedding")


@check(
    "w2_greedy_collapse",
    """select user_id, event_id, event_type from
    (select *, lag(event_type) over (partition by user_id order by ts, event_id) as previous from events)
    where event_type is distinct from previous and event_type <> 'error'""",
)
def greedy_collapse(spark, sf):
    kept = W.greedy_collapse(_events(spark, sf), ["user_id"], _EVENT_ORDER, _hour(), "event_type", "error")
    return kept.select("user_id", "event_id", "event_type")


_COLLAPSED = f"""frames as (select user_id, strftime(ts, '%Y-%m-%d') as day, ts, event_id, event_type, {_ID_SQL} as token from events),
    seen as (select *, lag(token) over (partition by user_id, day order by ts, event_id) as previous from frames),
    kept as (select * from seen where token is distinct from previous and token <> 0),
    utterances as (select distinct user_id, day from frames)"""


def _sequences(spark, sf):
    frames = _events(spark, sf)
    by, coarse = ["user_id", "day"], _hour()
    tokens = W.greedy_collapse(frames, by, _EVENT_ORDER, coarse)
    return W.collect_sequences(tokens, frames.select(*by).distinct(), by, _EVENT_ORDER, coarse)


@check(
    "w2_collect_sequences",
    f"""with {_COLLAPSED} select u.user_id, u.day, coalesce(string_agg(token::varchar, ',' order by ts, event_id), '') as tokens
    from utterances u left join kept k on u.user_id = k.user_id and u.day = k.day group by all""",
)
def sequences(spark, sf):
    return _sequences(spark, sf).withColumn("tokens", F.array_join("tokens", ","))


@check(
    "w3_pad_batch",
    f"""with {_COLLAPSED}, s as (select u.user_id, u.day, coalesce(list(token order by ts, event_id) filter (token is not null), []) as t
        from utterances u left join kept k on u.user_id = k.user_id and u.day = k.day group by all),
    m as (select *, max(len(t)) over (partition by user_id) as n from s)
    select user_id, day, len(t) as length,
        array_to_string(list_transform(list_concat(t, list_transform(generate_series(len(t) + 1, n), lambda x: 0)), lambda x: x::varchar), ',') as tokens from m""",
)
def pad_batch(spark, sf):
    padded = W.pad_batch(_sequences(spark, sf), ["user_id"])
    return padded.select("user_id", "day", F.col("length").cast("bigint").alias("length"), F.array_join("tokens", ",").alias("tokens"))


@check(
    "j6_decode_tokens",
    """select user_id, strftime(ts, '%Y-%m-%d') as day, coalesce(string_agg(substr(event_type, 1, 3) || ' ', '' order by ts, event_id)
    filter (event_type <> 'error'), '') as text from events group by all""",
)
def decode_tokens(spark, sf):
    events = _events(spark, sf)
    vocab = events.select(
        F.col("token").alias("token_id"),
        F.concat(F.substring("event_type", 1, 3), F.lit(" ")).alias("piece"),
        (F.col("event_type") == "error").alias("special"),
    ).distinct()
    return W.decode_tokens(events, vocab, ["user_id", "day"], _EVENT_ORDER, _hour())


_PAIRS = f"""pairs as (select a.item_id as id, substr(a.text, 1, 1) as split, {_words_sql('a.text')} as r, {_words_sql('b.text')} as h
    from benchmark a join benchmark b on b.item_id = a.item_id + 1)"""
# Rows of the edit distance table, one per step; the running minimum covers insertions.
_DISTANCE = f"""{_PAIRS}, cells(id, i, j, d) as (
    select id, 0::bigint, unnest(generate_series(0, len(h))), unnest(generate_series(0, len(h))) from pairs
    union all
    select id, i + 1, j, j + min(m - j) over (partition by id order by j rows unbounded preceding) from (
        select c.id, c.i, c.j, case when c.j = 0 then c.i + 1 else least(c.d + 1,
            lag(c.d) over (partition by c.id order by c.j) + case when p.r[c.i + 1] = p.h[c.j] then 0 else 1 end) end as m
        from cells c join pairs p on c.id = p.id where c.i < len(p.r))),
    errors as (select p.id, p.split, d as errors, len(p.r) as length from cells c join pairs p on c.id = p.id and i = len(r) and j = len(h))"""


def _pairs(spark, sf):
    items = table(spark, sf, "benchmark")
    refs = items.select(F.col("item_id").alias("utt_id"), F.col("text").alias("ref"))
    hyps = items.select((F.col("item_id") - 1).alias("utt_id"), F.col("text").alias("hyp"))
    return J.pair_transcripts(refs, hyps).withColumn("split", F.substring("ref", 1, 1))


@check(
    "j4_pair_transcripts",
    "select a.item_id as utt_id, a.text as ref, b.text as hyp from benchmark a join benchmark b on b.item_id = a.item_id + 1",
)
def pair_transcripts(spark, sf):
    return _pairs(spark, sf).drop("split")


@check(
    "a7_wer",
    f"""with recursive {_DISTANCE} select sum(errors)::bigint as errors, sum(length)::bigint as length,
    round(sum(errors) * 100 / sum(length), 6) as wer from errors""",
)
def wer(spark, sf):
    return E.wer(_pairs(spark, sf)).withColumn("wer", F.round("wer", 6))


@check(
    "a7_wer_by_split",
    f"""with recursive {_DISTANCE} select split, sum(errors)::bigint as errors, sum(length)::bigint as length,
    round(sum(errors) * 100 / sum(length), 6) as wer from errors group by split""",
)
def wer_by_split(spark, sf):
    return E.wer(_pairs(spark, sf), ["split"]).withColumn("wer", F.round("wer", 6))


# Replacing k words of a text by a word it does not have gives an edit distance of exactly k.
_REPLACED = ["the", "and", "la", "de", "der"]


@check(
    "a7_wer_documents",
    f"""with w as (select lang as language, {_words_sql('text')} as r from documents)
    select language, sum(len(list_filter(r, lambda w: lower(w) in ('the', 'and', 'la', 'de', 'der'))))::bigint as errors, sum(len(r))::bigint as length,
    round(sum(len(list_filter(r, lambda w: lower(w) in ('the', 'and', 'la', 'de', 'der')))) * 100 / sum(len(r)), 6) as wer from w group by language""",
)
def wer_documents(spark, sf):
    heard = F.regexp_replace("text", f"(?i)(?<!\\S)({'|'.join(_REPLACED)})(?!\\S)", "#")
    pairs = table(spark, sf, "documents").select(
        F.col("lang").alias("language"), F.col("text").alias("ref"), heard.alias("hyp")
    )
    return E.wer(pairs, ["language"]).withColumn("wer", F.round("wer", 6))


_UNITS = f"""{_COLLAPSED}, refs as (select user_id, day, string_agg({_LETTER_SQL}, '' order by ts, event_id) as ref from frames group by all),
    hyps as (select user_id, day, string_agg({_LETTER_SQL}, '' order by ts, event_id) as hyp from kept group by all),
    units as (select r.user_id, levenshtein(ref, coalesce(hyp, '')) as errors, length(ref) as length
        from refs r left join hyps h on r.user_id = h.user_id and r.day = h.day),
    rates as (select user_id, sum(errors)::bigint as errors, sum(length)::bigint as length, round(sum(errors) * 100 / sum(length), 6) as uer
        from units group by user_id)"""


def _token_pairs(spark, sf):
    frames = _events(spark, sf)
    refs = W.collect_ordered(frames, ["user_id", "day"], _EVENT_ORDER, "token", _hour(), "ref_tokens")
    return refs.join(_sequences(spark, sf).withColumnRenamed("tokens", "hyp_tokens"), ["user_id", "day"])


@check("a8_uer", f"with {_UNITS} select user_id, errors, length, uer from rates")
def uer(spark, sf):
    return E.uer(_token_pairs(spark, sf), ["user_id"]).withColumn("uer", F.round("uer", 6))


@check("a9_publish_gate", f"with {_UNITS} select user_id, uer, uer as wer from rates where uer >= 30")
def publish_gate(spark, sf):
    pairs = _token_pairs(spark, sf)
    units = E.uer(pairs, ["user_id"]).select("user_id", F.round("uer", 6).alias("uer"))
    texts = pairs.select("user_id", F.array_join("ref_tokens", " ").alias("ref"), F.array_join("hyp_tokens", " ").alias("hyp"))
    words = E.wer(texts, ["user_id"]).select("user_id", F.round("wer", 6).alias("wer"))
    return E.publish_gate(units.join(words, "user_id"), 30.0)


@check(
    "score_frames",
    """with frames as (select label || '-' || vec_id // 64 as utt, vec_id, list_position(embedding, list_max(embedding)) - 1 as token from embeddings),
    seen as (select *, lag(token) over (partition by utt order by vec_id) as previous from frames),
    refs as (select utt, string_agg(chr((33 + token)::int), '' order by vec_id) as ref from frames group by utt),
    hyps as (select utt, string_agg(chr((33 + token)::int), '' order by vec_id) as hyp from seen
        where token is distinct from previous and token <> 0 group by utt),
    rate as (select round(sum(levenshtein(ref, coalesce(hyp, ''))) * 100 / sum(length(ref)), 6) as r
        from refs left join hyps using (utt))
    select r as wer, r as uer from rate""",
)
def score_frames(spark, sf):
    frames = table(spark, sf, "embeddings").select(
        F.concat_ws("-", "label", F.floor(F.col("vec_id") / 64)).alias("utt_id"),
        F.col("vec_id").alias("frame_idx"),
        F.col("embedding").alias("scores"),
    )
    coarse = number_slice("frame_idx", 16)
    tokens = W.argmax_frames(frames)
    vocab = tokens.select(
        F.col("token").alias("token_id"), F.concat(F.lit("t"), "token", F.lit(" ")).alias("piece"), F.lit(False).alias("special")
    ).distinct()
    arrays = W.collect_ordered(tokens, ["utt_id"], ["frame_idx"], "token", coarse, "ref_tokens")
    pieces = F.transform("ref_tokens", lambda t: F.concat(F.lit("t"), t.cast("string")))
    references = arrays.withColumn("ref", F.array_join(pieces, " "))
    rates = score(frames, references, vocab, coarse)
    return rates.select(F.round("wer", 6).alias("wer"), F.round("uer", 6).alias("uer"))
