"""Stage encoders, truncation and padding.

Row-local operators are array expressions (``transform``/``aggregate``/
``slice``) evaluated in the JVM; only T15 (batch maximum) and T18 (stacking
inside a batch) look at other rows, and both are bounded by the batch size.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weft.functions.tokens import DEFAULT_TOKENIZER, IGNORE_INDEX, left_pad, right_pad, truncate

EMPTY_INT = "array<int>"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def encode_supervised(df: DataFrame, max_source: int, max_target: int, tokenizer=DEFAULT_TOKENIZER,
                      dialog: str = "dialog") -> DataFrame:
    """``<bos> X Y <eos>`` per turn with labels ``<ignore>... Y <eos>``.

    Each source is cut to ``max_source`` (bos only on the first turn), each
    target to ``max_target - 1``; turns are appended until the next one
    would exceed ``max_source + max_target`` (stop, not skip).
    """
    tk = tokenizer
    max_len = max_source + max_target
    d = F.col(dialog)
    n_turns = F.floor(F.size(d) / 2).cast("int")
    idx = F.when(n_turns > 0, F.sequence(F.lit(0), n_turns - 1)).otherwise(F.array().cast(EMPTY_INT))
    # sources/targets are gathered as text arrays and tokenised per array, so
    # a Python tokenizer never runs inside a lambda
    out = (df.withColumn("_src", tk.ids_many(F.transform(idx, lambda i: d[2 * i])))
             .withColumn("_tgt", tk.ids_many(F.transform(idx, lambda i: d[2 * i + 1]))))
    src = F.transform("_src", lambda x, i: truncate(F.when(i == 0, F.concat(F.array(F.lit(tk.bos_id)), x)).otherwise(x),
                                                    max_source))
    tgt = F.transform("_tgt", lambda x: truncate(x, max_target - 1))
    out = out.withColumn("_turns", F.zip_with(src, tgt, lambda a, b: F.struct(a.alias("src"), b.alias("tgt")))).drop("_src", "_tgt")
    init = F.struct(F.lit(0).alias("used"), F.lit(0).alias("n"), F.lit(False).alias("stop"))

    def step(acc, t):
        ln = F.size(t["src"]) + F.size(t["tgt"]) + 1
        over = acc["stop"] | (acc["used"] + ln > max_len)
        return F.when(over, F.struct(acc["used"].alias("used"), acc["n"].alias("n"), F.lit(True).alias("stop"))) \
            .otherwise(F.struct((acc["used"] + ln).alias("used"), (acc["n"] + 1).alias("n"), F.lit(False).alias("stop")))

    kept = F.slice(F.col("_turns"), F.lit(1), F.aggregate(F.col("_turns"), init, step)["n"])
    eos = F.array(F.lit(tk.eos_id))
    out = (out.withColumn("input_ids", F.flatten(F.transform(kept, lambda t: F.concat(t["src"], t["tgt"], eos))))
              .withColumn("labels", F.flatten(F.transform(kept, lambda t: F.concat(
                  F.array_repeat(F.lit(IGNORE_INDEX), F.size(t["src"])), t["tgt"], eos)))))
    return out.drop("_turns")


def encode_unsupervised(df: DataFrame, max_source: int, max_target: int, tokenizer=DEFAULT_TOKENIZER,
                        dialog: str = "dialog") -> DataFrame:
    """Prompt (all but the last element, joined) and answer, each encoded
    with specials and truncated separately."""
    tk = tokenizer
    d = F.col(dialog)
    prompt = F.array_join(F.slice(d, F.lit(1), F.size(d) - 1), "")
    answer = F.element_at(d, -1)
    return (df.withColumn("input_ids", truncate(tk.ids(prompt, add_special=True), max_source))
              .withColumn("labels", truncate(tk.ids(answer, add_special=True), max_target)))


def encode_pairwise(df: DataFrame, max_source: int, max_target: int, tokenizer=DEFAULT_TOKENIZER,
                    prompt: str = "prompt_text", chosen: str = "chosen", rejected: str = "rejected") -> DataFrame:
    """T4: ``accept_ids``/``reject_ids`` = source (with specials, cut to
    max_source) + answer (cut to max_target - 1) + eos.  ``prompt`` is the
    rendered prompt (P4) and the two answers come from
    :func:`split_pair_response`."""
    tk = tokenizer
    src = truncate(tk.ids(F.col(prompt), add_special=True), max_source)
    eos = F.array(F.lit(tk.eos_id))
    out = df.withColumn("_src", src)
    return (out.withColumn("accept_ids", F.concat(F.col("_src"), truncate(tk.ids(F.col(chosen)), max_target - 1), eos))
               .withColumn("reject_ids", F.concat(F.col("_src"), truncate(tk.ids(F.col(rejected)), max_target - 1), eos))
               .drop("_src"))


def split_pair_response(df: DataFrame, response: str = "response") -> DataFrame:
    """Require ARRAY<STRING> of size 2 and split into chosen/rejected."""
    dt = df.schema[response].dataType
    if dt.typeName() != "array":
        raise TypeError(f"pairwise response must be ARRAY<STRING> [accepted, rejected], got {dt.simpleString()}")
    r = F.col(response)
    checked = F.when(F.size(r) == 2, r).otherwise(F.raise_error(F.lit("pairwise response must hold exactly 2 answers")))
    return df.withColumn("chosen", F.get(checked, 0)).withColumn("rejected", F.get(r, 1))


def truncate_line(ids, limit: int) -> Column:
    """Over the limit keep the first ``limit - 1`` ids."""
    ids = _c(ids)
    return F.when(F.size(ids) > limit, F.slice(ids, F.lit(1), F.lit(limit - 1))).otherwise(ids)


def fixed_length(df: DataFrame, text: str, max_seq: int, eoc_token: str = "<|endoftext|>",
                 tokenizer=DEFAULT_TOKENIZER, prefix: str = "") -> DataFrame:
    """``text + end-of-conversation`` encoded with specials, cut and
    right-padded to ``max_seq``; mask 1 on real tokens."""
    tk = tokenizer
    ids = truncate(tk.ids(F.concat(F.col(text), F.lit(eoc_token)), add_special=True), max_seq)
    out = df.withColumn(f"{prefix}_n", F.size(ids))
    out = out.withColumn(f"{prefix}input_ids", right_pad(ids, max_seq, tk.pad_id))
    out = out.withColumn(f"{prefix}attention_mask", F.concat(F.array_repeat(F.lit(1), F.col(f"{prefix}_n")),
                                                           F.array_repeat(F.lit(0), F.lit(max_seq) - F.col(f"{prefix}_n"))))
    return out.drop(f"{prefix}_n")


def prompt_left_pad(df: DataFrame, text: str, max_seq: int, max_token_len: int,
                    tokenizer=DEFAULT_TOKENIZER) -> DataFrame:
    """Prompt ids with specials; longer than ``max_seq`` keeps the last
    ``max_seq - 1``; left-padded to ``max_token_len`` with a 0/1 mask."""
    tk = tokenizer
    ids = tk.ids(F.col(text), add_special=True)
    out = df.withColumn("_ids", ids)
    n = F.size("_ids")
    cut = F.when(n > max_seq, F.slice(F.col("_ids"), n - (max_seq - 1) + 1, F.lit(max_seq - 1))).otherwise(F.col("_ids"))
    out = out.withColumn("_cut", cut)
    width = F.greatest(F.lit(max_token_len), F.size("_cut"))
    return (out.withColumn("prompt", left_pad(F.col("_cut"), width, tk.pad_id))
               .withColumn("prompt_att_mask", left_pad(F.array_repeat(F.lit(1), F.size("_cut")), width, 0))
               .drop("_ids", "_cut"))


def batch_pad(df: DataFrame, batch: str, ids: str = "input_ids", labels: str | None = "labels",
              pad_id: int = 0, label_pad: int = IGNORE_INDEX) -> DataFrame:
    """Right-pad ids and labels, each to its own longest sequence in the
    batch, so that both are rectangular.  The window is partitioned by batch
    id, so each window holds one (bounded) batch."""
    w = Window.partitionBy(batch)
    fills = {ids: pad_id} | ({labels: label_pad} if labels else {})
    out = df.withColumns({f"_w_{c}": F.max(F.size(c)).over(w) for c in fills})
    out = out.withColumns({c: F.concat(F.col(c), F.array_repeat(F.lit(fill), F.col(f"_w_{c}") - F.size(c))) for c, fill in fills.items()})
    return out.drop(*[f"_w_{c}" for c in fills])


def pad_to_target(src, tgt, pad_id: int) -> Column:
    """Left-pad ``src`` to the length of ``tgt``."""
    return left_pad(_c(src), F.size(_c(tgt)), pad_id)


def strip_padding(query, response, pad_id: int) -> tuple[Column, Column]:
    """Drop left padding of the query and right padding of the response."""
    q, r = _c(query), _c(response)
    q_first = F.array_position(F.transform(q, lambda x: x != pad_id), True)
    r_last = F.size(r) - F.array_position(F.reverse(F.transform(r, lambda x: x != pad_id)), True) + 1
    q_out = F.when(q_first > 0, F.slice(q, q_first, F.size(q) - q_first + 1)).otherwise(F.array().cast(EMPTY_INT))
    r_out = F.when(r_last <= F.size(r), F.slice(r, F.lit(1), r_last)).otherwise(F.array().cast(EMPTY_INT))
    return q_out, r_out


def stack_pairs(df: DataFrame, batch: str, pos: str | list[str], chosen: str, rejected: str,
                chosen_mask: str | None = None, rejected_mask: str | None = None) -> DataFrame:
    """Per batch, all accepted rows first, then all rejected rows.
    Output ``(batch, row, side, input_ids[, attention_mask])`` where
    ``row = side * batch_rows + number in batch`` by ``pos`` (rows with equal
    positions get numbers of their own).  The batch size is bounded, so the
    per-batch count is a small window."""
    order = [pos] if isinstance(pos, str) else list(pos)
    n = F.count(F.lit(1)).over(Window.partitionBy(batch))
    base = df.withColumn("_n", n).withColumn("_r", F.row_number().over(Window.partitionBy(batch).orderBy(*order, chosen, rejected)) - 1)

    def side(s, ids, mask):
        fields = [(F.lit(s) * F.col("_n") + F.col("_r")).alias("row"), F.lit(s).alias("side"), F.col(ids).alias("input_ids")]
        if chosen_mask:
            fields.append(F.col(mask).alias("attention_mask"))
        return F.struct(*fields)

    # both sides from one pass over the batch window (explode, not a union)
    both = F.array(side(0, chosen, chosen_mask), side(1, rejected, rejected_mask))
    out = base.select(F.col(batch), F.explode(both).alias("_s"))
    cols = ["row", "side", "input_ids"] + (["attention_mask"] if chosen_mask else [])
    return out.select(batch, *[F.col(f"_s.{c}").alias(c) for c in cols])


def phase_record(df: DataFrame, phase: int, pad_id: int = 0, mask_pads: bool = False) -> DataFrame:
    """The training record of each phase.  ``mask_pads`` sets phase-1
    labels to the ignored index where the attention mask is 0."""
    if phase == 1:
        labels = F.col("input_ids")
        if mask_pads:
            labels = F.zip_with("input_ids", "attention_mask", lambda i, m: F.when(m == 1, i).otherwise(F.lit(IGNORE_INDEX)))
        return df.select("input_ids", "attention_mask", labels.alias("labels"))
    if phase == 2:
        return df.select("chosen_input_ids", "chosen_attention_mask", "rejected_input_ids", "rejected_attention_mask")
    if phase == 3:
        return df.select("prompt", "prompt_att_mask", F.lit(pad_id).alias("pad_token_id"))
    raise ValueError(f"unknown phase {phase}")


def has_answer(seq, prompt_length, pad_id: int) -> Column:
    """keep sequences with more than one non-pad token after the prompt
    (``prompt_length`` is the padded prompt width, an int or a Column)."""
    s = _c(seq)
    pl = prompt_length if isinstance(prompt_length, Column) else F.lit(prompt_length)
    ans = F.slice(s, (pl + 1).cast("int"), F.greatest(F.size(s) - pl, F.lit(0)).cast("int"))
    return F.size(F.filter(ans, lambda x: x != pad_id)) > 1
