"""Preference-source adapters (P6-P17) and the null filter F3.

Every adapter maps one source schema onto the common five projections
``prompt, chosen, rejected, prompt_and_chosen, prompt_and_rejected``
(null where a source has no such side), keeping any other columns.
Pure column expressions: no shuffle.
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

OUT = ("prompt", "chosen", "rejected", "prompt_and_chosen", "prompt_and_rejected")

# Speaker markers used by the adapters.
HUMAN = " Human: "
ASSISTANT = " Assistant:"
ASSISTANT_SP = " Assistant: "
# Citation patterns stripped from web answers (``.`` written as [^\n]).
CITE_WITH_SPACE = r" [\(\[][^\n]*?[\)\]]"
CITE = r"[\(\[][^\n]*?[\)\]]"


def _project(df: DataFrame, prompt: Column, chosen: Column, rejected: Column,
             prompt_and_chosen: Column, prompt_and_rejected: Column) -> DataFrame:
    cols = dict(zip(OUT, (prompt, chosen, rejected, prompt_and_chosen, prompt_and_rejected)))
    keep = [c for c in df.columns if c not in cols]
    return df.select(*keep, *[v.cast("string").alias(k) for k, v in cols.items()])


def _null() -> Column:
    return F.lit(None).cast("string")


def identity_pairs(df: DataFrame) -> DataFrame:
    """prompt/chosen/rejected as-is; pairs are plain concatenations."""
    p, c, r = F.col("prompt"), F.col("chosen"), F.col("rejected")
    return _project(df, p, c, r, F.concat(p, c), F.concat(p, r))


def wrapped_pairs(df: DataFrame) -> DataFrame:
    """Flat columns wrapped as `` Human: p Assistant:``."""
    p, c, r = F.col("prompt"), F.col("chosen"), F.col("rejected")
    return _project(df, F.concat(F.lit(HUMAN), p, F.lit(ASSISTANT)),
                    F.concat(F.lit(" "), c), F.concat(F.lit(" "), r),
                    F.concat(F.lit(HUMAN), p, F.lit(ASSISTANT_SP), c),
                    F.concat(F.lit(HUMAN), p, F.lit(ASSISTANT_SP), r))


def last_assistant_pairs(df: DataFrame) -> DataFrame:
    """Prompt + ``Assistant:``; sides keep the text after the last ``Assistant:``."""
    p, c, r = F.col("prompt"), F.col("chosen"), F.col("rejected")

    def last(x):
        return F.element_at(F.split(x, "Assistant:", -1), -1)

    return _project(df, F.concat(p, F.lit("Assistant:")), last(c), last(r), F.concat(p, c), F.concat(p, r))


def strip_citations(c: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(c, CITE_WITH_SPACE, ""), CITE, "")


def scored_pairs(df: DataFrame) -> DataFrame:
    """Winner by score (tie -> answer_0), bracketed citations removed."""
    q = F.col("question.full_text")
    s0, s1 = F.col("score_0").cast("double"), F.col("score_1").cast("double")
    win = strip_citations(F.when(s0 >= s1, F.col("answer_0")).otherwise(F.col("answer_1")))
    lose = strip_citations(F.when(s0 < s1, F.col("answer_0")).otherwise(F.col("answer_1")))
    pre = F.concat(F.lit(HUMAN), q, F.lit(ASSISTANT_SP))
    return _project(df, F.concat(F.lit(HUMAN), q, F.lit(ASSISTANT)), F.concat(F.lit(" "), win),
                    F.concat(F.lit(" "), lose), F.concat(pre, win), F.concat(pre, lose))


def labelled_pairs(df: DataFrame) -> DataFrame:
    """P10: winner by integer label (1 -> A)."""
    a_wins = F.col("labels").cast("int") == 1
    win = F.when(a_wins, F.col("human_ref_A")).otherwise(F.col("human_ref_B"))
    lose = F.when(a_wins, F.col("human_ref_B")).otherwise(F.col("human_ref_A"))
    h = F.col("history")
    pre = F.concat(F.lit(HUMAN), h, F.lit(ASSISTANT_SP))
    return _project(df, F.concat(F.lit(HUMAN), h, F.lit(ASSISTANT)), F.concat(F.lit(" "), win),
                    F.concat(F.lit(" "), lose), F.concat(pre, win), F.concat(pre, lose))


def _nonempty(c: Column) -> Column:
    return F.coalesce(F.length(c) > 0, F.lit(False))


def renamed_roles(df: DataFrame) -> DataFrame:
    """USER/ASSISTANT -> Human/Assistant; null/empty -> null; no rejected side."""
    p, lab = F.col("prompt"), F.col("label")
    pr = F.replace(F.replace(p, F.lit("USER"), F.lit("Human")), F.lit("ASSISTANT"), F.lit("Assistant"))
    prompt = F.when(_nonempty(p), pr)
    chosen = F.when(_nonempty(lab), F.concat(F.lit(" "), lab))
    pc = F.when(_nonempty(p) & _nonempty(lab), F.concat(pr, F.lit(" "), lab))
    return _project(df, prompt, chosen, _null(), pc, _null())


def local_json_pairs(df: DataFrame) -> DataFrame:
    """Leading-space concatenation, null if any part is null."""
    p, c, r = F.col("prompt"), F.col("chosen"), F.col("rejected")
    sp = F.lit(" ")
    return _project(df, F.concat(sp, p), F.concat(sp, c), F.concat(sp, r),
                    F.concat(sp, p, sp, c), F.concat(sp, p, sp, r))


def instruction_response(df: DataFrame) -> DataFrame:
    """INSTRUCTION/RESPONSE columns, no rejected side."""
    i, r = F.col("INSTRUCTION"), F.col("RESPONSE")
    return _project(df, F.concat(F.lit(HUMAN), i, F.lit(ASSISTANT)), F.concat(F.lit(" "), r), _null(),
                    F.concat(F.lit(HUMAN), i, F.lit(ASSISTANT_SP), r), _null())


def passages(df: DataFrame) -> DataFrame:
    """First positive / first negative passage; empty negatives -> null."""
    q = F.col("query")
    pos = F.get(F.col("positive_passages"), 0)["text"]
    neg = F.get(F.col("negative_passages"), 0)["text"]
    pre = F.concat(F.lit(HUMAN), q, F.lit(ASSISTANT_SP))
    return _project(df, F.concat(F.lit(HUMAN), q, F.lit(ASSISTANT)), F.concat(F.lit(" "), pos),
                    F.concat(F.lit(" "), neg), F.concat(pre, pos), F.concat(pre, neg))


def first_answer(df: DataFrame) -> DataFrame:
    """Question + first human answer; no rejected side."""
    q = F.col("question")
    a = F.get(F.col("human_answers"), 0)
    return _project(df, F.concat(F.lit(HUMAN), q, F.lit(ASSISTANT)), F.concat(F.lit(" "), a), _null(),
                    F.concat(F.lit(HUMAN), q, F.lit(ASSISTANT_SP), a), _null())


def multilingual(lang: str = "zh_cn") -> Callable[[DataFrame], DataFrame]:
    """Nested per-language struct; first answer text in ``lang``."""
    def fn(df: DataFrame) -> DataFrame:
        q = F.col("queries")[lang]
        a = F.get(F.col("answers")[lang], 0)["text"]
        return _project(df, F.concat(F.lit(HUMAN), q, F.lit(ASSISTANT)), F.concat(F.lit(" "), a), _null(),
                        F.concat(F.lit(HUMAN), q, F.lit(ASSISTANT_SP), a), _null())
    return fn


# Dataset-name substrings dispatched to each adapter, in the
# reference's order (first match wins).
ADAPTERS: list[tuple[str, Callable[[DataFrame], DataFrame]]] = [
    ("Dahoas/rm-static", identity_pairs),
    ("Dahoas/full-hh-rlhf", identity_pairs),
    ("Dahoas/synthetic-instruct-gptj-pairwise", wrapped_pairs),
    ("yitingxie/rlhf-reward-datasets", last_assistant_pairs),
    ("openai/webgpt_comparisons", scored_pairs),
    ("stanfordnlp/SHP", labelled_pairs),
    ("pvduy/sharegpt_alpaca_oa_vicuna_format", renamed_roles),
    ("wangrui6/Zhihu-KOL", instruction_response),
    ("Cohere/miracl-zh-queries-22-12", passages),
    ("Hello-SimpleAI/HC3-Chinese", first_answer),
    ("mkqa-Chinese", multilingual("zh_cn")),
    ("local/jsonfile", local_json_pairs),
]

_USER_ADAPTERS: list[tuple[str, Callable[[DataFrame], DataFrame]]] = []


def register_adapter(name: str, fn: Callable[[DataFrame], DataFrame]) -> None:
    """A user adapter, matched before the built-ins (re-registering a
    name replaces it)."""
    _USER_ADAPTERS[:] = [(k, f) for k, f in _USER_ADAPTERS if k != name]
    _USER_ADAPTERS.insert(0, (name, fn))


def get_adapter(dataset_name: str) -> Callable[[DataFrame], DataFrame]:
    """Dispatch by dataset-name substring; unknown names raise."""
    for key, fn in _USER_ADAPTERS + ADAPTERS:
        if key in dataset_name:
            return fn
    raise ValueError(f"No adapter for dataset {dataset_name}; register one with register_adapter().")


def drop_null_sides(df: DataFrame, phase: int) -> DataFrame:
    """phase 1 needs prompt+chosen, phase 2 both pairs, phase 3 the prompt."""
    need = {1: ["prompt_and_chosen"], 2: ["prompt_and_chosen", "prompt_and_rejected"], 3: ["prompt"]}[phase]
    return df.dropna(subset=need)
