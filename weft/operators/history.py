"""Multi-turn conversations: pair extraction, history expansion (T8), token
budget fitting (T9-T12, F2, F6) and cumulative transcripts (W1, W6).

All budget logic is row-local: per-turn lengths are carried in an array and
folded newest-first with ``aggregate``; only the kept suffix of the history
is materialised as text/ids.  The shuffles are the pair join on
``(conv_id, turn)`` and the history of T8, which with a bounded
look-back runs per (conversation, chunk) with a halo of the previous rows, so
a huge conversation spreads over many tasks.  Without a bound T8's output is
quadratic in the conversation by definition, as are W1 and W6: there
:func:`with_earlier` scans over chunks of a conversation, so that tasks hold a
chunk's rows and what comes before them, and no window runs over a conversation.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weft.functions.tokens import DEFAULT_TOKENIZER, IGNORE_INDEX

HISTORY_TYPE = "array<struct<query:string,answer:string>>"

# Role markers of the two encode styles (fixed values).
ROLE_MARKER_STYLE = {"user_token": "<reserved_102>", "assistant_token": "<reserved_103>", "eos_token": "</s>"}
ROUND_STYLE = {"user_token": "问：", "assistant_token": "答："}


PROMPT_SALTS = 16


def chat_pairs(turns: DataFrame, conv: str = "conv_id", turn: str = "turn",
               role: str = "role", text: str = "text") -> DataFrame:
    """User turn followed by an assistant turn -> (conv_id, turn, query, response, prompt).

    ``prompt`` is the conversation's first system turn (null if none).  Both
    sides of a pair meet in one aggregate on (conv, the user's turn), from one
    scan; no key holds more than two rows.  Prompts are joined on (conv, salt),
    each prompt copied to every salt, so a conversation with most turns is
    spread.  (conv, turn) is unique; rows where either is null pair with none.
    """
    t = turns.select(F.col(conv).alias("conv_id"), F.col(turn).alias("turn"), F.col(role).alias("r"), F.col(text).alias("x"))
    at = F.when(F.col("r") == "assistant", F.col("turn") - 1).otherwise(F.col("turn"))
    is_user, is_bot = F.col("r") == "user", F.col("r") == "assistant"
    pairs = (t.where(F.col("r").isin("user", "assistant") & F.col("conv_id").isNotNull() & F.col("turn").isNotNull())
             .groupBy("conv_id", at.alias("turn"))
             .agg(F.count_if(is_user).alias("u"), F.count_if(is_bot).alias("b"),
                  F.any_value(F.when(is_user, F.struct("x")), True)["x"].alias("query"),
                  F.any_value(F.when(is_bot, F.struct("x")), True)["x"].alias("response"))
             .where((F.col("u") > 0) & (F.col("b") > 0)).drop("u", "b"))
    system = (t.where(F.col("r") == "system").groupBy("conv_id").agg(F.min_by("x", "turn").alias("prompt"))
              .withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(PROMPT_SALTS - 1)))))
    salted = pairs.withColumn("salt", F.pmod("turn", F.lit(PROMPT_SALTS)).cast("int"))
    return salted.join(system, ["conv_id", "salt"], "left").drop("salt")


def with_earlier(df: DataFrame, conv: str, order: str, item: Column, out: str, as_text: bool = False, chunk: int = 64,
                 position: str | None = None) -> DataFrame:
    """``out`` = the ``item`` of every earlier row of the conversation, oldest first: an array, or one text (nulls skipped).

    A segmented prefix scan.  Rows get a dense position and are gathered into
    chunks of ``chunk`` rows.  Each later chunk asks for each earlier one by
    (conversation, chunk), a small table of numbers, so a conversation of n
    rows moves n * n / (2 * chunk) items, spread over its n / chunk chunks; a
    chunk's prefix is put together once, and its rows add the
    rows before them in the chunk.  A null conversation is one too.
    ``position`` names a column for the 0-based place."""
    from weft.operators.split import ordered_index
    row = F.struct(*[F.col(f"`{c}`") for c in df.columns])
    # a struct is never null, so a null conversation joins like any other
    d = df.select(F.struct(F.col(conv)).alias("_conv"), F.col(order).alias("_order"), row.alias("_row"), item.alias("_item"))
    d = ordered_index(d, ["_order"], out="_pos", partition_cols=["_conv"]).withColumn("_chunk", F.floor(F.col("_pos") / chunk))
    # a number of partitions of its own: what follows is far larger than what is shuffled here
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    blocks = (d.repartition(parts, "_conv", "_chunk").groupBy("_conv", "_chunk")
              .agg(F.array_sort(F.collect_list(F.struct("_pos", F.struct("_item", "_row").alias("x")))).alias("_xs"))
              .withColumn("_xs", F.transform("_xs", lambda e: e["x"])))

    def items(xs: Column) -> Column:
        return F.transform(xs, lambda e: e["_item"])

    content = F.array_join(items(F.col("_xs")), "") if as_text else items(F.col("_xs"))
    held = blocks.select(F.col("_conv").alias("_hv"), F.col("_chunk").alias("_hc"), content.alias("_held"))
    asked = blocks.where(F.col("_chunk") > 0).select(F.col("_conv").alias("_av"), F.col("_chunk").alias("_ac"),
                                                     F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("_chunk") - 1)).alias("_b"))
    prefix = (asked.join(held, (F.col("_av") == F.col("_hv")) & (F.col("_b") == F.col("_hc")))
              .groupBy("_av", "_ac").agg(F.array_sort(F.collect_list(F.struct("_b", "_held"))).alias("_parts")))
    parts_before = F.transform("_parts", lambda e: e["_held"])
    prefix = prefix.select("_av", "_ac", (F.array_join(parts_before, "") if as_text else F.flatten(parts_before)).alias("_prefix"))
    both = blocks.join(prefix, (F.col("_conv") == F.col("_av")) & (F.col("_chunk") == F.col("_ac")), "left")
    rows = both.select("_prefix", "_xs", "_chunk", F.posexplode("_xs").alias("_i", "_x"))
    near = items(F.slice("_xs", F.lit(1), F.col("_i")))
    before = (F.concat(F.coalesce("_prefix", F.lit("")), F.array_join(near, "")) if as_text
              else F.when(F.col("_prefix").isNull(), near).otherwise(F.concat("_prefix", near)))
    place = [(F.col("_chunk") * chunk + F.col("_i")).alias(position)] if position else []
    return rows.select("_x._row.*", before.alias(out), *place)


def expand_history(pairs: DataFrame, conv: str = "conv_id", order: str = "turn",
                   query: str = "query", response: str = "response", max_history: int | None = None,
                   chunk: int = 4096, carry: dict[str, str] | None = None, locked: int = 0) -> DataFrame:
    """One row per turn with all earlier turns of the conversation as
    ``history`` ARRAY<STRUCT<query, answer>> (chronological).

    Without ``max_history`` the turns come from :func:`with_earlier`.
    ``max_history`` bounds the look-back frame.  With a token budget it can
    be set exactly (see :func:`max_fitting_turns`): turns beyond it could
    never be kept, so results are unchanged while rows stop growing with the
    conversation length.  A bounded frame also lets a huge conversation be
    split: pairs get a dense position (skew-resistant ordered index), are cut
    into chunks of ``chunk`` positions, and the last ``max_history`` rows of
    each chunk are copied (one ``explode``, no self-union) into the next
    chunk as a halo.  The window then runs per (conversation, chunk), so no
    partition holds more than ``chunk + max_history`` rows.

    ``locked`` sets the conversation's first turns apart: column ``locked``
    holds those of them that are earlier, ``history`` the turns after them.
    They are read from the same positions and joined by salt."""
    extra = [F.col(src).alias(name) for name, src in (carry or {}).items()]
    struct = F.struct(F.col(query).alias("query"), F.col(response).alias("answer"), *extra)
    if max_history is None:
        out = with_earlier(pairs, conv, order, struct, "history")
        if not locked:
            return out
        return (out.withColumn("locked", F.slice("history", F.lit(1), F.lit(locked)))
                .withColumn("history", F.slice("history", F.lit(locked + 1), F.greatest(F.size("history") - locked, F.lit(0)))))
    if max_history <= 0 and not locked:   # an empty array of the history struct type
        return pairs.withColumn("history", F.filter(F.array(struct), lambda x: F.lit(False)))
    from weft.operators.split import ordered_index
    k, size = max(max_history, 0), max(chunk, max_history)
    d = ordered_index(pairs, [order], out="_pos", partition_cols=[conv]).withColumn(
        "_chunk", F.floor(F.col("_pos") / size).cast("bigint"))
    tail = F.pmod(F.col("_pos"), F.lit(size)) >= size - k
    copies = F.when(tail, F.array(F.struct(F.col("_chunk").alias("c"), F.lit(False).alias("halo")),
                                  F.struct((F.col("_chunk") + 1).alias("c"), F.lit(True).alias("halo")))) \
              .otherwise(F.array(F.struct(F.col("_chunk").alias("c"), F.lit(False).alias("halo"))))
    d = d.withColumn("_copy", F.explode(copies)).withColumn("_chunk", F.col("_copy.c"))
    w = Window.partitionBy(conv, "_chunk").orderBy("_pos").rowsBetween(-k, -1)
    later = F.when(F.col("_pos") >= locked, struct) if locked else struct   # null: left out of the list
    out = d.withColumn("history", F.collect_list(later).over(w)).where(~F.col("_copy.halo")).drop("_chunk", "_copy")
    return (_with_front(out, struct, conv, locked, "locked") if locked else out).drop("_pos")


def _with_front(d: DataFrame, turn: Column, conv: str, limit: int, out: str) -> DataFrame:
    """``out`` = the earlier rows among the conversation's first ``limit`` (by the dense ``_pos``), at most ``limit`` of
    a conversation, joined on (conv, salt) so that a huge conversation is spread."""
    front = (d.where(F.col("_pos") < limit).groupBy(F.col(conv).alias("_conv"))
             .agg(F.transform(F.array_sort(F.collect_list(F.struct(F.col("_pos").alias("p"), turn.alias("t")))), lambda x: x["t"]).alias("_front"))
             .withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(PROMPT_SALTS - 1)))))
    both = d.withColumn("_salted", F.pmod("_pos", F.lit(PROMPT_SALTS)).cast("int")).join(
        front, F.col(conv).eqNullSafe(F.col("_conv")) & (F.col("_salted") == F.col("_salt")))
    return (both.withColumn(out, F.slice("_front", F.lit(1), F.least(F.col("_pos"), F.lit(limit)).cast("int")))
            .drop("_conv", "_front", "_salt", "_salted"))


def expand_front(pairs: DataFrame, limit: int, conv: str = "conv_id", order: str = "turn",
                 query: str = "query", response: str = "response") -> DataFrame:
    """T8 for encoders that cut from the front: ``history`` holds the earlier
    turns among the conversation's first ``limit``.

    An encoder that stops after ``limit`` tokens reads no further if every
    turn costs a token or more, so its output is unchanged, while rows stop
    growing with the conversation.  The first turns (at most ``limit`` of a
    conversation, one array) are joined back on (conv, salt), so a huge
    conversation is spread over tasks."""
    from weft.operators.split import ordered_index
    d = ordered_index(pairs, [order], out="_pos", partition_cols=[conv])
    return _with_front(d, F.struct(F.col(query).alias("query"), F.col(response).alias("answer")), conv, limit, "history").drop("_pos")


def expand_nested(df: DataFrame, chat: str = "chat", q: str = "input", a: str = "output") -> DataFrame:
    """T8 for rows that already hold the turn list: one row per element, the
    earlier elements as history.  No shuffle."""
    out = df.select("*", F.posexplode(chat).alias("turn", "_cur"))
    hist = F.transform(F.slice(F.col(chat), F.lit(1), F.col("turn")),
                       lambda x: F.struct(x[q].alias("query"), x[a].alias("answer")))
    return (out.withColumn("history", F.when(F.col("turn") > 0, hist).otherwise(F.array().cast(HISTORY_TYPE)))
            .withColumn("query", F.col("_cur")[q]).withColumn("response", F.col("_cur")[a])
            .drop("_cur"))


def _empty_turn(style: dict) -> list[str]:
    """The pieces of a history turn that are tokenised apart, for an empty question and answer: role-marker styles have an
    end token, round styles a header a round."""
    if "eos_token" in style:
        return [style["user_token"] + "\n" + style["assistant_token"] + "\n" + style["eos_token"]]
    return ["[Round 1]\n\n", style["user_token"] + "\n\n" + style["assistant_token"] + "\n\n"]


def min_turn_cost(tokenizer=DEFAULT_TOKENIZER, style: dict | None = None) -> int | None:
    """Fewest tokens any rendered history turn can cost (the markers of an
    empty turn), or None when the tokenizer gives no static bound.

    The tokenizer's own expression counts them, in Spark: a literal row, folded
    by the optimizer without a job, so any alphabet and pattern is read as it
    will be at run time.  A tokenizer gives a bound if ``monotone``: more text
    never means fewer tokens."""
    from pyspark.sql import SparkSession
    if not getattr(tokenizer, "monotone", False):
        return None
    spark = SparkSession.active()
    costs = [tokenizer.count(F.lit(text)) for text in _empty_turn(style or ROLE_MARKER_STYLE)]
    return sum(spark.sql("SELECT 1").select(*costs).first())


def max_fitting_turns(budget: int, tokenizer=DEFAULT_TOKENIZER, style: dict | None = None) -> int | None:
    """Upper bound on history turns a budget fit can keep (exact look-back)."""
    c = min_turn_cost(tokenizer, style)
    return None if not c else budget // c


def drop_missing_chat(df: DataFrame, chat: str = "chat") -> DataFrame:
    """skip rows without a turn list."""
    return df.where(F.col(chat).isNotNull())


def clamp_budget(model_max: int | None, requested: int) -> int:
    """the budget can never exceed the model limit."""
    return requested if model_max is None else min(model_max, requested)


def _fit_count(costs: Column, start: Column, budget: int) -> Column:
    """Number of newest-first entries of ``costs`` that fit: add while
    ``used + cost <= budget``, stop at the first that does not."""
    init = F.struct(start.alias("used"), F.lit(0).alias("n"), F.lit(False).alias("stop"))

    def step(acc, x):
        over = acc["stop"] | (acc["used"] + x > budget)
        return F.when(over, F.struct(acc["used"].alias("used"), acc["n"].alias("n"), F.lit(True).alias("stop"))) \
            .otherwise(F.struct((acc["used"] + x).alias("used"), (acc["n"] + 1).alias("n"), F.lit(False).alias("stop")))

    return F.aggregate(costs, init, step)["n"]


def _suffix(arr: Column, n: Column) -> Column:
    return F.when(n > 0, F.slice(arr, F.size(arr) - n + 1, n)).otherwise(F.slice(arr, 1, 0))


def turn_token_count(tokenizer=DEFAULT_TOKENIZER, style: dict | None = None, query: str = "query",
                     response: str = "response") -> Column:
    """Tokens of one rendered role-marker turn; carry it through
    :func:`expand_history` (``carry={"n_tokens": ...}``) so the budget fit
    folds precomputed lengths instead of re-tokenising every history turn."""
    s = style or ROLE_MARKER_STYLE
    return tokenizer.count(F.concat(F.lit(s["user_token"]), F.coalesce(F.col(query), F.lit("")), F.lit("\n"),
                                    F.lit(s["assistant_token"]), F.coalesce(F.col(response), F.lit("")), F.lit("\n"),
                                    F.lit(s["eos_token"])))


def fit_history(df: DataFrame, budget: int, tokenizer=DEFAULT_TOKENIZER, style: dict | None = None,
                count_prompt: bool = False, query: str = "query", response: str = "response",
                history: str = "history", prompt: str | None = "prompt", length_field: str | None = None,
                current_length: str | None = None) -> DataFrame:
    """T9 (role-marker style) + F2.

    Each turn renders as ``user q \\n assistant a \\n eos``.  Rows whose
    prompt and current turn together exceed the budget are dropped (F2);
    earlier turns are added newest-first while the running length stays
    within the budget, stopping at the first that does not fit.  The running
    length leaves the prompt out, as the reference does, unless
    ``count_prompt``.  Labels equal ids.  ``current_length`` names a column
    that already holds the current turn's token count.
    """
    s = style or ROLE_MARKER_STYLE
    tk = tokenizer

    def turn_text(q, a):
        return F.concat(F.lit(s["user_token"]), F.coalesce(q, F.lit("")), F.lit("\n"), F.lit(s["assistant_token"]),
                        F.coalesce(a, F.lit("")), F.lit("\n"), F.lit(s["eos_token"]))

    prompt_col = F.col(prompt) if prompt else F.lit(None).cast("string")
    prompt_ids = F.when(F.coalesce(prompt_col, F.lit("")) != "", tk.ids(prompt_col)).otherwise(F.array().cast("array<int>"))
    hist_type = df.schema[history].dataType if history in df.columns else None
    if hist_type is None or hist_type.typeName() != "array":
        hist_type = HISTORY_TYPE
    hist = F.coalesce(F.col(history), F.array().cast(hist_type))
    # rows are dropped on token counts, before any id is made
    cur = turn_text(F.col(query), F.col(response))
    n_cur = F.col(current_length) if current_length else tk.count(cur)
    n_prompt = F.when(F.coalesce(prompt_col, F.lit("")) != "", tk.count(prompt_col)).otherwise(F.lit(0))
    out = (df.withColumn("_hist", hist).withColumn("_n_cur", n_cur).withColumn("_n_prompt", n_prompt)
             .where(F.col("_n_cur") + F.col("_n_prompt") <= budget)
             .withColumn("_start", F.col("_n_cur") + (F.col("_n_prompt") if count_prompt else F.lit(0))))
    # turn texts are rendered in the JVM, then tokenised as one array (a
    # Python tokenizer cannot run inside a higher-order lambda)
    if length_field:
        # lengths carried from the pairs: no history turn is rendered or
        # tokenised except the kept suffix
        lens = F.transform(F.col("_hist"), lambda h: h[length_field])
        out = out.withColumn("n_history", _fit_count(F.reverse(lens), F.col("_start"), budget))
        out = out.withColumn("kept_history", _suffix(F.col("_hist"), F.col("n_history")))
        kept_texts = F.transform(F.col("kept_history"), lambda h: turn_text(h["query"], h["answer"]))
    else:
        out = out.withColumn("_htexts", F.transform(F.col("_hist"), lambda h: turn_text(h["query"], h["answer"])))
        out = out.withColumn("n_history", _fit_count(F.reverse(tk.count_many(F.col("_htexts"))), F.col("_start"), budget))
        out = out.withColumn("kept_history", _suffix(F.col("_hist"), F.col("n_history")))
        kept_texts = _suffix(F.col("_htexts"), F.col("n_history"))
    out = (out.withColumn("input_ids", F.concat(prompt_ids, F.flatten(tk.ids_many(kept_texts)), tk.ids(cur)))
              .withColumn("labels", F.col("input_ids")))
    return out.drop("_n_cur", "_n_prompt", "_hist", "_start", "_htexts")


def round_turn_token_count(tokenizer=DEFAULT_TOKENIZER, style: dict | None = None, query: str = "query",
                           response: str = "response") -> Column:
    """Tokens of one round-style history turn (``user q \\n\\n assistant a \\n\\n``),
    to carry through :func:`expand_history` for :func:`fit_history_rounds`."""
    s = style or ROUND_STYLE
    return tokenizer.count(F.concat(F.lit(s["user_token"]), F.coalesce(F.col(query), F.lit("")), F.lit("\n\n"),
                                    F.lit(s["assistant_token"]), F.coalesce(F.col(response), F.lit("")), F.lit("\n\n")))


def fit_history_rounds(df: DataFrame, budget: int, tokenizer=DEFAULT_TOKENIZER, style: dict | None = None,
                       prefix_ids: tuple[int, ...] = (), mask_pad: bool = True, query: str = "query",
                       response: str = "response", history: str = "history", prompt: str | None = "prompt",
                       length_field: str | None = None) -> DataFrame:
    """``[Round i]`` headers, prompt counted, labels masked except the
    answer (+eos).  Rows whose current turn does not fit are dropped."""
    s = style or ROUND_STYLE
    tk = tokenizer
    pad = tk.pad_id

    def q_text(q):
        return F.concat(F.lit(s["user_token"]), F.coalesce(q, F.lit("")), F.lit("\n\n"), F.lit(s["assistant_token"]))

    def h_text(q, a):
        return F.concat(q_text(q), F.coalesce(a, F.lit("")), F.lit("\n\n"))

    def round_text(i):  # i is 1-based
        return F.concat(F.lit("[Round "), i.cast("string"), F.lit("]\n\n"))

    prompt_col = F.col(prompt) if prompt else F.lit(None).cast("string")
    head = F.concat(F.array(*[F.lit(x) for x in prefix_ids]).cast("array<int>"),
                    F.when(F.coalesce(prompt_col, F.lit("")) != "", tk.ids(prompt_col)).otherwise(F.array().cast("array<int>")))
    hist_type = df.schema[history].dataType if history in df.columns else None
    if hist_type is None or hist_type.typeName() != "array":
        hist_type = HISTORY_TYPE
    out = (df.withColumn("_hist", F.coalesce(F.col(history), F.array().cast(hist_type)))
             .withColumn("_head", head)
             .withColumn("_q_ids", tk.ids(q_text(F.col(query))))
             .withColumn("_a_ids", F.concat(tk.ids(F.coalesce(F.col(response), F.lit(""))), F.array(F.lit(tk.eos_id))))
             .withColumn("_start", F.size("_head") + tk.count(round_text(F.lit(1))) + F.size("_q_ids") + F.size("_a_ids")))
    out = out.where(F.col("_start") <= budget)
    # newest-first cost of history entry k (0-based): its ids + header "[Round k+2]"
    rev = F.reverse(F.col("_hist"))
    if length_field:   # carried per-pair counts: history turns are not re-tokenised
        h_lens = F.transform(rev, lambda h: h[length_field])
    else:
        h_lens = tk.count_many(F.transform(rev, lambda h: h_text(h["query"], h["answer"])))
    costs = F.zip_with(h_lens, tk.count_many(F.transform(rev, lambda h, k: round_text(k + 2))), lambda a, b: a + b)
    out = out.withColumn("n_history", _fit_count(costs, F.col("_start"), budget))
    kept = _suffix(F.col("_hist"), F.col("n_history"))
    out = out.withColumn("_kept", kept)
    body = F.flatten(F.zip_with(tk.ids_many(F.transform("_kept", lambda h, j: round_text(j + 1))),
                                tk.ids_many(F.transform("_kept", lambda h: h_text(h["query"], h["answer"]))),
                                lambda a, b: F.concat(a, b)))
    ctx = F.concat(F.col("_head"), body, tk.ids(round_text(F.col("n_history") + 1)), F.col("_q_ids"))
    labels = F.concat(F.array_repeat(F.lit(pad), F.size(ctx)), F.col("_a_ids"))
    if mask_pad:
        labels = F.transform(labels, lambda x: F.when(x == pad, F.lit(IGNORE_INDEX)).otherwise(x))
    out = (out.withColumn("kept_history", kept)
              .withColumn("input_ids", F.concat(ctx, F.col("_a_ids")))
              .withColumn("labels", labels))
    return out.drop("_hist", "_head", "_q_ids", "_a_ids", "_start", "_kept")


def encode_classification(df: DataFrame, budget: int, tokenizer=DEFAULT_TOKENIZER, style: dict | None = None,
                          text: str = "input", label: str = "label", history: str | None = None,
                          prompt: str | None = None) -> DataFrame:
    """``user + input + eos`` (no answer), newest-first history of
    earlier inputs, prompt prepended; label passes through; over-budget rows
    dropped."""
    s = style or ROLE_MARKER_STYLE
    tk = tokenizer

    def t(x):
        return F.concat(F.lit(s["user_token"]), F.coalesce(x, F.lit("")), F.lit(s["eos_token"]))

    prompt_col = F.col(prompt) if prompt else F.lit(None).cast("string")
    out = (df.withColumn("_cur_ids", tk.ids(t(F.col(text))))
             .withColumn("_prompt_ids", F.when(F.coalesce(prompt_col, F.lit("")) != "", tk.ids(prompt_col))
                         .otherwise(F.array().cast("array<int>"))))
    out = out.where(F.size("_cur_ids") + F.size("_prompt_ids") <= budget)
    if history:
        hist = F.coalesce(F.col(history), F.array().cast(HISTORY_TYPE))
        out = out.withColumn("_htexts", F.transform(hist, lambda h: t(h["query"])))
        n = _fit_count(F.reverse(tk.count_many(F.col("_htexts"))), F.size("_cur_ids"), budget)
        out = out.withColumn("n_history", n)
        hist_ids = F.flatten(tk.ids_many(_suffix(F.col("_htexts"), F.col("n_history"))))
    else:
        out = out.withColumn("n_history", F.lit(0))
        hist_ids = F.array().cast("array<int>")
    out = out.withColumn("input_ids", F.concat(F.col("_prompt_ids"), hist_ids, F.col("_cur_ids")))
    return out.withColumn("label", F.col(label)).drop("_cur_ids", "_prompt_ids", "_htexts")


def inference_context(df: DataFrame, budget: int, tokenizer=DEFAULT_TOKENIZER, style: dict | None = None,
                      query: str = "query", history: str = "history", locked: str | None = None,
                      prompt: str | None = "prompt", length_field: str | None = None) -> DataFrame:
    """Prompt + locked turns (never dropped) + newest-first history +
    current query.  Adds ``status`` ('ok', 'query_too_long',
    'locked_too_long'), ``input_ids`` and ``kept_history`` instead of
    returning None.  ``length_field`` names a token count carried in the
    history structs, so that only the kept turns are tokenised."""
    s = style or ROLE_MARKER_STYLE
    tk = tokenizer

    def turn_text(q, a):
        return F.concat(F.lit(s["user_token"]), F.coalesce(q, F.lit("")), F.lit("\n"), F.lit(s["assistant_token"]),
                        F.coalesce(a, F.lit("")), F.lit("\n"), F.lit(s["eos_token"]))

    prompt_col = F.col(prompt) if prompt else F.lit(None).cast("string")
    empty = F.array().cast("array<int>")
    locked_col = F.coalesce(F.col(locked), F.array().cast(df.schema[locked].dataType)) if locked else F.array().cast(HISTORY_TYPE)
    hist = F.coalesce(F.col(history), F.array().cast(df.schema[history].dataType))
    out = (df.withColumn("_prompt_ids", F.when(F.coalesce(prompt_col, F.lit("")) != "", tk.ids(prompt_col)).otherwise(empty))
             .withColumn("_q_ids", tk.ids(F.concat(F.lit(s["user_token"]), F.coalesce(F.col(query), F.lit("")),
                                                   F.lit("\n"), F.lit(s["assistant_token"]))))
             .withColumn("_lock_ids", F.flatten(tk.ids_many(F.transform(locked_col, lambda h: turn_text(h["query"], h["answer"])))))
             .withColumn("_len1", F.size("_q_ids") + F.size("_prompt_ids"))
             .withColumn("_len2", F.col("_len1") + F.size("_lock_ids"))
             .withColumn("_hist", hist))
    costs = (F.transform("_hist", lambda h: h[length_field]) if length_field
             else tk.count_many(F.transform("_hist", lambda h: turn_text(h["query"], h["answer"]))))
    n = _fit_count(F.reverse(costs), F.col("_len2"), budget)
    status = (F.when(F.col("_len1") > budget, F.lit("query_too_long"))
               .when(F.col("_len2") > budget, F.lit("locked_too_long")).otherwise(F.lit("ok")))
    out = out.withColumn("status", status).withColumn("n_history", F.when(F.col("status") == "ok", n).otherwise(F.lit(0)))
    kept = F.transform(_suffix(F.col("_hist"), F.col("n_history")), lambda h: F.struct(h["query"].alias("query"), h["answer"].alias("answer")))
    out = out.withColumn("kept_history", F.when(F.col("status") == "ok", kept))
    kept_ids = F.flatten(tk.ids_many(F.transform("kept_history", lambda h: turn_text(h["query"], h["answer"]))))
    ids = F.concat(F.col("_prompt_ids"), F.col("_lock_ids"), kept_ids, F.col("_q_ids"))
    out = out.withColumn("input_ids", F.when(F.col("status") == "ok", ids))
    return out.drop("_prompt_ids", "_q_ids", "_lock_ids", "_len1", "_len2", "_hist")


def cumulative_questions(pairs: DataFrame, conv: str = "conv_id", order: str = "turn",
                         query: str = "query", response: str = "response") -> DataFrame:
    """Per turn, ``input: q1output: a1...input: q_i`` over the conversation (see :func:`with_earlier`)."""
    line = F.concat(F.lit("input: "), F.col(query), F.lit("output: "), F.col(response))
    out = with_earlier(pairs, conv, order, line, "_before", as_text=True)
    return out.withColumn("question", F.concat("_before", F.lit("input: "), F.col(query))).drop("_before")


def _fill(template: str, values: dict[str, Column]) -> Column:
    """Substitute ``{name}`` placeholders of a Python template with columns in
    one pass (as an f-string would; inserted text is never re-scanned)."""
    import re
    pieces = re.split("(" + "|".join(re.escape("{" + k + "}") for k in values) + ")", template)
    return F.concat(*[values[p[1:-1]] if p[1:-1] in values and p.startswith("{") else F.lit(p) for p in pieces if p])


def role_play_transcript(pairs: DataFrame, student_instruction: str, teacher_instruction: str,
                         profiler_template: str | None = None, conv: str = "conv_id", order: str = "turn",
                         query: str = "query", response: str = "response", profile: str | None = None) -> DataFrame:
    """Role-play transcript assembly.  Per turn ``i`` (1-based key
    ``turn_i``): the student prompt is the instruction + the transcript so
    far; the student line ``<student>: q\n</student>\n`` is appended and the
    teacher prompt is the instruction + that transcript; the teacher line
    ``<teacher>: a\n</teacher>\n`` closes the turn.  A profiler template may
    reference ``{dialog}`` (transcript through the student line) and
    ``{user_profile}`` (the ``profile`` column)."""
    s_line = F.concat(F.lit("<student>: "), F.col(query), F.lit("\n</student>\n"))
    t_line = F.concat(F.lit("<teacher>: "), F.col(response), F.lit("\n</teacher>\n"))
    out = with_earlier(pairs, conv, order, F.concat(s_line, t_line), "_before", as_text=True, position="_pos")
    out = (out.withColumn("_sl", s_line).withColumn("_tl", t_line)
              .withColumn("key", F.concat(F.lit("turn_"), (F.col("_pos") + 1).cast("string")))
              .withColumn("student_prompt", F.concat(F.lit(student_instruction), F.col("_before")))
              .withColumn("teacher_prompt", F.concat(F.lit(teacher_instruction), F.col("_before"), F.col("_sl")))
              .withColumn("transcript", F.concat(F.col("_before"), F.col("_sl"), F.col("_tl"))))
    if profiler_template is not None:
        prof = F.coalesce(F.col(profile), F.lit("")) if profile else F.lit("")
        out = out.withColumn("profiler_prompt", _fill(profiler_template, {
            "dialog": F.concat(F.col("_before"), F.col("_sl")), "user_profile": prof}))
    return out.drop("_sl", "_tl", "_before", "_pos")


# Encode styles by model family; users may register their own
# ``fn(df, budget, tokenizer) -> DataFrame`` (plug a tokenizer in through
# :class:`weft.functions.tokens.PandasTokenizer`).
ENCODE_STYLES = {
    "role_marker": lambda df, budget, tk: fit_history(df, budget, tk),
    "rounds": lambda df, budget, tk: fit_history_rounds(df, budget, tk),
    "classification": lambda df, budget, tk: encode_classification(df, budget, tk, text="query", label="label",
                                                                   history="history", prompt="prompt"),
}


def register_encode_style(name: str, fn) -> None:
    ENCODE_STYLES[name] = fn


def encode_chat(df: DataFrame, style: str, budget: int, tokenizer=DEFAULT_TOKENIZER) -> DataFrame:
    """Dispatch a chat encode by style name; unknown names raise."""
    if style not in ENCODE_STYLES:
        raise KeyError(f"unknown encode style {style}; known: {sorted(ENCODE_STYLES)}")
    return ENCODE_STYLES[style](df, budget, tokenizer)
