"""The registered queries: one or more per operator, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions import message as msg, tokens as tok
from ..functions.external_tokenizer import ExternalTokenizer
from ..operators import canonical, history, masking, rendering, stats, truncation, turn_truncation
from ..options import PrepOptions
from ..sources import shards, tables, turns as turn_ops
from . import external, inputs, prepare

# Token budgets at which every truncation branch has rows.
TURN_LIMIT = 512
LIST_LIMIT = 256
# Less than most conversations hold, more than most single turns.
HISTORY_BUDGET = 384

TURN_OPTIONS = PrepOptions(max_length=TURN_LIMIT)
LIST_OPTIONS = PrepOptions(max_length=LIST_LIMIT)
PAIR_KEYS = ("conv_id", "turn")

Query = Callable[[SparkSession, str], DataFrame]


def _long(c: Column | str) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("long")


def _joined(array: str) -> Column:
    return F.array_join(F.col(array), ",")


# --- sources ---------------------------------------------------------------


def assemble(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = turn_ops.assemble_conversations(inputs.conversations(spark, sf_dir))
    lines = F.transform("messages", lambda m: F.concat(m["role"], F.lit(": "), m["content"]))
    return rows.select(
        "conv_id",
        "part",
        _long(F.size("messages")).alias("n_messages"),
        F.array_join(lines, "\n").alias("messages_text"),
    )


def explode(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = turn_ops.assemble_conversations(inputs.conversations(spark, sf_dir))
    place = F.col("part") * turn_ops.MAX_TURNS_PER_ROW + F.col("position")
    return rendering.explode_messages(rows).select(
        "conv_id", place.alias("position"), "message.role", "message.content"
    )


def detect_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Message lists, prompt/response rows, and rows that are neither."""
    lists = inputs.message_lists(spark, sf_dir).withColumn("turn", _long(F.lit(0)))
    given = (lists, inputs.reply_pairs(spark, sf_dir), inputs.shapeless_rows(spark, sf_dir))
    found = [canonical.detect_schema(df).select(*PAIR_KEYS, "schema") for df in given]
    return found[0].unionByName(found[1]).unionByName(found[2])


def pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    flat = tables.read_pairs(
        inputs.reply_pairs(spark, sf_dir),
        "prompt",
        {c: c for c in ("response", "completion", "answer")},
        PAIR_KEYS,
    )
    rows = canonical.canonicalize(flat, keep=PAIR_KEYS)
    return rows.select(
        *PAIR_KEYS,
        "schema",
        F.get("messages", F.lit(0))["content"].alias("user_text"),
        F.get("messages", F.lit(1))["content"].alias("assistant_text"),
    )


# --- canonical form --------------------------------------------------------


def _turns(spark: SparkSession, sf_dir: str, **settings) -> DataFrame:
    opts = PrepOptions(**settings)
    turns = inputs.varied_turns(spark, sf_dir)
    return turn_ops.canonical_turns(turns, opts, text="content").filter(~F.col("is_dropped"))


def _message_rows(turns: DataFrame, *fields: str) -> DataFrame:
    return turns.select("conv_id", F.col("pos").alias("turn"), *fields)


def clean_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _message_rows(_turns(spark, sf_dir, extract_think_tags=False), "role", "content")


def reasoning_norm(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = _turns(spark, sf_dir, extract_think_tags=False)
    return _message_rows(turns, "reasoning_content", "moved").withColumn("moved", _long("moved"))


def think_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _message_rows(_turns(spark, sf_dir), "content", "reasoning_content", "extracted")
    return rows.withColumn("extracted", _long("extracted"))


def think_cap(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = _turns(spark, sf_dir, think_max_tokens=20)
    return _message_rows(turns, "role", "content", "reasoning_content")


def think_policy(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = _turns(spark, sf_dir, think_mode="drop")
    return _message_rows(turns, "role", "content", "reasoning_content")


def tools_norm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return canonical.normalize_tools(inputs.message_lists(spark, sf_dir)).select(
        "conv_id", "tools", "tools_from_string"
    )


def unknown_roles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return turn_ops.unknown_role_turns(_turns(spark, sf_dir), PrepOptions())


def turn_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    opts = PrepOptions(think_mode="drop")
    turns = turn_ops.canonical_turns(inputs.varied_turns(spark, sf_dir), opts, text="content")
    return turn_ops.conversation_totals(turns).select(
        "conv_id",
        "extracted_think",
        "moved_reasoning",
        "dropped_think",
        "n_messages",
        "total_tokens",
    )


def _reported(spark: SparkSession, sf_dir: str, **settings) -> DataFrame:
    return canonical.canonicalize(inputs.message_lists(spark, sf_dir), PrepOptions(**settings))


def parse_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = F.col("report")
    return _reported(spark, sf_dir, think_mode="drop").select(
        "conv_id",
        "schema",
        _long(r["extracted_think"]).alias("extracted_think"),
        _long(r["moved_reasoning"]).alias("moved_reasoning"),
        _long(r["dropped_think"]).alias("dropped_think"),
        r["tools_present"].alias("tools_present"),
        r["tools_from_string"].alias("tools_from_string"),
        F.array_join(r["unknown_roles"], ",").alias("unknown_roles"),
    )


def parse_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals over message lists, prompt/response rows and rows that are neither."""
    given = (
        _reported(spark, sf_dir, think_mode="drop"),
        canonical.canonicalize(inputs.reply_pairs(spark, sf_dir)),
        canonical.canonicalize(inputs.shapeless_rows(spark, sf_dir)),
    )
    reports = [df.select("schema", "report") for df in given]
    return canonical.parse_report_summary(reports[0].union(reports[1]).union(reports[2]))


def unknown_role_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return canonical.unknown_role_counts(_reported(spark, sf_dir))


# --- rendering and tokens --------------------------------------------------


def _rendered_turns(turns: DataFrame) -> DataFrame:
    text = msg.render(turn_ops.message_columns())
    return turns.select("conv_id", F.col("pos").alias("turn"), "role", text.alias("rendered"))


def rendered(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rendered_turns(_turns(spark, sf_dir)).drop("role")


def rendered_tools(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rendering.render_messages(_reported(spark, sf_dir)).select("conv_id", "rendered")


def token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens per conversation, summed over turns; nothing is assembled."""
    turns = turn_ops.canonical_turns(inputs.conversations(spark, sf_dir))
    return turn_ops.conversation_totals(turns).select(
        "conv_id", "n_messages", "total_tokens"
    )


def exchange_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rendering.count_tokens(_reported(spark, sf_dir)).select(
        "conv_id", _long("total_tokens").alias("total_tokens")
    )


def token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = _rendered_turns(turn_ops.canonical_turns(inputs.conversations(spark, sf_dir)))
    words = pieces.select(F.explode(tok.tokens(F.col("rendered"))).alias("token")).distinct()
    return words.withColumn("token_id", _long(tok.token_id(F.col("token"))))


def role_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return turn_ops.role_spans(_rendered_turns(_turns(spark, sf_dir))).select(
        "conv_id", "turn", "role", "span_start", _long("span_end").alias("span_end")
    )


def token_offsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = turn_ops.token_offsets(_rendered_turns(_turns(spark, sf_dir)))
    return rows.withColumn("place", _long("place"))


# --- truncation ------------------------------------------------------------


def _fitting(spark: SparkSession, sf_dir: str, opts: PrepOptions = TURN_OPTIONS) -> DataFrame:
    turns = inputs.varied_turns(spark, sf_dir)
    return prepare.turn_rows(turns, opts, text="content")


def anchors(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = truncation.truncation_anchors(_fitting(spark, sf_dir))
    place = F.get("messages", F.col("tail_start"))
    last = F.get("messages", F.col("last_assistant"))
    return rows.select(
        "conv_id",
        _long("head").alias("head"),
        place["pos"].alias("tail_turn"),
        last["pos"].alias("last_assistant_turn"),
    )


def drop_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = rendering.tokenize_messages(_fitting(spark, sf_dir))
    rows = truncation.drop_middle(truncation.truncation_anchors(rows), TURN_LIMIT)
    first_kept = F.get("messages", F.col("head") + F.col("dropped"))
    return rows.select(
        "conv_id",
        _long("raw_total").alias("raw_total"),
        "over",
        _long("dropped_turns").alias("dropped"),
        first_kept["pos"].alias("first_kept_turn"),
    )


def turn_cuts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What `drop_middle` tells, decided at turn grain."""
    turns = inputs.varied_turns(spark, sf_dir)
    placed = turn_truncation.placed_turns(turns, TURN_OPTIONS, text="content")
    return placed.filter(F.col("rank") == F.col("from_rank")).select(
        "conv_id",
        _long("raw_total").alias("raw_total"),
        "over",
        (F.col("from_rank") - F.col("head")).alias("dropped"),
        F.col("pos").alias("first_kept_turn"),
    )


def halve_reasoning(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reasoning of every kept message after fitting."""
    rows = prepare.fitted_turns(inputs.varied_turns(spark, sf_dir), TURN_OPTIONS, text="content")
    return rows.select(
        "conv_id",
        F.col("pos").alias("turn"),
        "reasoning_content",
        _long(tok.token_count(F.col("rendered"))).alias("n_tokens"),
    )


def trace(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prepare.prepare_turn_lengths(
        inputs.varied_turns(spark, sf_dir), TURN_OPTIONS, text="content"
    ).select(
        "conv_id",
        _long("raw_length").alias("raw_length"),
        _long("structured_length").alias("structured_length"),
        _long("final_length").alias("final_length"),
        "stage",
    )


# --- loss and samples ------------------------------------------------------


def _loss(mode: str) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        opts = PrepOptions(think_loss=mode)
        rows = _rendered_turns(_turns(spark, sf_dir))
        rows = rows.withColumn("tokens", tok.tokens(F.col("rendered")))
        marked = rows.withColumn("m", masking.mark_spans(F.struct("role", "tokens"), opts))
        return marked.select(
            "conv_id",
            "turn",
            F.posexplode(masking.marked_tokens(F.col("m"), opts)).alias("place", "t"),
        ).select("conv_id", "turn", _long("place").alias("place"), "t.token", "t.in_loss")

    return query


def token_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token rows of message lists, tool schemas included."""
    opts = PrepOptions(max_length=0, think_loss="answer_only")
    rows = prepare.fit(_reported(spark, sf_dir), opts)
    long = masking.token_labels_long(rows.select("conv_id", "messages"), opts)
    return long.select(
        "conv_id",
        _long("message_index").alias("message_index"),
        "role",
        _long("place").alias("place"),
        "token",
        "in_loss",
    )


def _sample_rows(samples: DataFrame, *keys: str) -> DataFrame:
    return samples.select(
        *keys,
        _joined("input_ids").alias("input_ids"),
        _joined("labels").alias("labels"),
        _long(F.size("attention_mask")).alias("n_attended"),
        _long("original_length").alias("original_length"),
        _long("raw_length").alias("raw_length"),
    )


def _turn_samples(spark: SparkSession, sf_dir: str, **settings) -> DataFrame:
    opts = PrepOptions(max_length=TURN_LIMIT, **settings)
    return prepare.prepare_turn_samples(inputs.varied_turns(spark, sf_dir), opts, text="content")


def samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _sample_rows(_turn_samples(spark, sf_dir), "conv_id")


def truncate_right(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _turn_samples(
        spark, sf_dir, truncate_side="right", think_loss="answer_only", drop_if_no_assistant=False
    )
    return _sample_rows(rows, "conv_id")


def truncate_left(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _turn_samples(spark, sf_dir, think_loss="answer_plus_think", drop_if_no_assistant=False)
    return _sample_rows(rows, "conv_id")


def exchange_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = prepare.prepare_samples(inputs.message_lists(spark, sf_dir), LIST_OPTIONS)
    return _sample_rows(rows, "conv_id")


def external_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Message lists through the plug-in tokenizer path, with the built-in split in Python."""
    pattern = tok.TOKEN_PATTERN

    def make():
        import hashlib

        import regex

        split = regex.compile(pattern)

        def encode(text: str) -> tuple[list[int], list[tuple[int, int]]]:
            found = list(split.finditer(text))
            ids = [int(hashlib.md5(m.group().encode()).hexdigest()[:15], 16) for m in found]
            return ids, [m.span() for m in found]

        return encode

    rows = external.prepare_samples_with(
        inputs.message_lists(spark, sf_dir), ExternalTokenizer(make, atomic_markers=True), LIST_OPTIONS
    )
    return _sample_rows(rows, "conv_id")


def sample_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = stats.sample_stats(_turn_samples(spark, sf_dir))
    return rows.select(
        "conv_id",
        _long("total_tokens").alias("total_tokens"),
        _long("loss_tokens").alias("loss_tokens"),
        "was_truncated",
    )


def debug(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first 20 conversations by key; the limit is the feature."""
    shown = prepare.debug_samples(inputs.message_lists(spark, sf_dir), LIST_OPTIONS, 20)
    return shown.select(
        "conv_id",
        "schema",
        "tools_present",
        _long("extracted_think").alias("extracted_think"),
        _joined("unknown_roles").alias("unknown_roles"),
        _long("raw_length").alias("raw_length"),
        _long("structured_length").alias("structured_length"),
        _long("final_length").alias("final_length"),
        _long("loss_tokens").alias("loss_tokens"),
        "final_text",
    )


# --- reports ---------------------------------------------------------------


def _lengths(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prepare.prepare_turn_lengths(inputs.conversations(spark, sf_dir), TURN_OPTIONS)


def _histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.length_histogram(_lengths(spark, sf_dir))


def len_hist(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _histogram(spark, sf_dir).withColumn("length", _long("length"))


def len_pct(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.length_percentiles(_histogram(spark, sf_dir), TURN_LIMIT)


def utilisation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.window_utilisation(_histogram(spark, sf_dir), TURN_LIMIT)


def trunc_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.truncation_summary(_histogram(spark, sf_dir), TURN_LIMIT)


def raw_len(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.raw_lengths(_lengths(spark, sf_dir))


def advice(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.length_advice(_histogram(spark, sf_dir), TURN_LIMIT)


def role_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens and loss tokens by role, at turn grain."""
    opts = PrepOptions(think_loss="answer_only")
    rows = _rendered_turns(_turns(spark, sf_dir))
    rows = rows.withColumn("tokens", tok.tokens(F.col("rendered")))
    marked = rows.select("role", masking.mark_spans(F.struct("role", "tokens"), opts).alias("m"))
    in_loss = F.size(F.filter(masking.marked_tokens(F.col("m"), opts), lambda t: t["in_loss"]))
    return stats.role_totals(
        marked.select("role", F.size("m.tokens").alias("n_tokens"), in_loss.alias("n_loss"))
    )


def tools_overhead(spark: SparkSession, sf_dir: str) -> DataFrame:
    costs = rendering.count_tokens(_reported(spark, sf_dir))
    bare = rendering.count_tokens(costs.select("conv_id", "messages", F.lit(None).cast("string").alias("tools"), F.col("total_tokens").alias("whole")))
    return stats.tools_overhead(
        bare.select(F.col("whole").alias("total_tokens"), (F.col("whole") - F.col("total_tokens")).alias("tools_cost")), TURN_LIMIT
    )


def token_freq(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = _rendered_turns(turn_ops.canonical_turns(inputs.conversations(spark, sf_dir)))
    return stats.token_frequencies(pieces.select(F.explode(tok.tokens(F.col("rendered"))).alias("token")))


# --- prompts ---------------------------------------------------------------


def gen_prompts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations with tools, ready for the next reply without thinking."""
    rows = rendering.generation_prompts(_reported(spark, sf_dir), thinking=False)
    return rows.select("conv_id", "generation_prompt")


def text_prompts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = rendering.prompts_from_text(inputs.benchmark(spark, sf_dir), "text")
    return rows.select("item_id", "generation_prompt")


def rendered_lengths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flagship: length percentiles of whole rendered conversations."""
    turns = turn_ops.canonical_turns(inputs.conversations(spark, sf_dir))
    totals = turn_ops.conversation_totals(turns)
    return stats.length_percentiles(stats.length_histogram(totals, "total_tokens"))


def shard_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows and tokens of four shards of the samples."""
    rows = prepare.prepare_turn_samples(inputs.varied_turns(spark, sf_dir), TURN_OPTIONS, text="content")
    placed = shards.with_shard(rows, 4)
    totals = shards.shard_totals(placed, rows.columns, shards.SHARD)
    return totals.select(_long(shards.SHARD).alias("shard"), "n_rows", "n_tokens")


def history_prompts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return history.history_prompts(inputs.varied_turns(spark, sf_dir), HISTORY_BUDGET, text="content")


QUERIES: dict[str, Query] = {
    "assemble": assemble,
    "explode": explode,
    "detect_schema": detect_schema,
    "pairs": pairs,
    "clean_messages": clean_messages,
    "reasoning_norm": reasoning_norm,
    "think_extract": think_extract,
    "think_cap": think_cap,
    "think_policy": think_policy,
    "tools_norm": tools_norm,
    "unknown_roles": unknown_roles,
    "turn_report": turn_report,
    "parse_report": parse_report,
    "parse_summary": parse_summary,
    "unknown_role_counts": unknown_role_counts,
    "rendered": rendered,
    "rendered_tools": rendered_tools,
    "token_counts": token_counts,
    "exchange_token_counts": exchange_token_counts,
    "token_ids": token_ids,
    "role_spans": role_spans,
    "token_offsets": token_offsets,
    "anchors": anchors,
    "drop_middle": drop_middle,
    "turn_cuts": turn_cuts,
    "halve_reasoning": halve_reasoning,
    "trace": trace,
    "truncate_left": truncate_left,
    "truncate_right": truncate_right,
    "loss_all": _loss("all"),
    "loss_answer_only": _loss("answer_only"),
    "loss_answer_plus_think": _loss("answer_plus_think"),
    "token_labels": token_labels,
    "samples": samples,
    "exchange_samples": exchange_samples,
    "external_samples": external_samples,
    "sample_stats": sample_stats,
    "debug": debug,
    "len_hist": len_hist,
    "len_pct": len_pct,
    "utilisation": utilisation,
    "trunc_summary": trunc_summary,
    "raw_len": raw_len,
    "advice": advice,
    "role_totals": role_totals,
    "tools_overhead": tools_overhead,
    "token_freq": token_freq,
    "gen_prompts": gen_prompts,
    "history_prompts": history_prompts,
    "shard_plan": shard_plan,
    "text_prompts": text_prompts,
    "rendered_lengths": rendered_lengths,
}
