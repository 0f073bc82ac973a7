"""End-to-end preparation flows.

``prepare`` dispatches an aligned dataset to the stage encoder; ``create_dataset``
runs the preference flow adapter -> phase split -> null filter -> fixed-length
encoding -> per-phase record for a train and an eval source.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

from weft.functions.templates import chat_format
from weft.functions.tokens import DEFAULT_TOKENIZER
from weft.operators import adapters as AD
from weft.operators import align as AL
from weft.operators import encode as EN
from weft.operators import pack as PK
from weft.operators import split as SP


@dataclass
class StageConfig:
    template: str = "default"
    max_source_length: int = 512
    max_target_length: int = 512
    predict_with_generate: bool = False
    pack_group: str = "pack_group"
    pack_order: str = "doc_id"
    tokenizer: object = DEFAULT_TOKENIZER


def prepare(df: DataFrame, stage: str, cfg: StageConfig | None = None) -> DataFrame:
    """G5: 'pt' packs the prompt text (T5); 'sft' encodes supervised turns
    (T2, or T3 when predicting with generate); 'rm' encodes accepted/rejected
    pairs (T4); 'ppo' encodes prompt/answer (T3).  Rows go through F1/P2/P3
    first for the dialog stages."""
    cfg = cfg or StageConfig()
    tk = cfg.tokenizer
    if stage == "pt":
        return PK.pack_pretrain(df, cfg.max_source_length, cfg.pack_group, cfg.pack_order, "prompt", tk)
    t = chat_format(cfg.template)
    if stage == "rm":
        kept = AL.keep_nonempty(df)
        kept = EN.split_pair_response(kept)
        kept = AL.with_prompt(kept, t)
        return EN.encode_pairwise(kept, cfg.max_source_length, cfg.max_target_length, tk)
    d = AL.with_dialog(df, t)
    if stage == "sft" and not cfg.predict_with_generate:
        return EN.encode_supervised(d, cfg.max_source_length, cfg.max_target_length, tk)
    if stage in ("sft", "ppo"):
        return EN.encode_unsupervised(d, cfg.max_source_length, cfg.max_target_length, tk)
    raise ValueError(f"unknown stage {stage}")


def create_split(df: DataFrame, dataset_name: str, phase: int, data_split: str, key_cols: list[str], seed: int,
                 eoc_token: str, max_seq: int, tokenizer=DEFAULT_TOKENIZER) -> DataFrame:
    """One side (train or eval) of G6."""
    adapted = AD.get_adapter(dataset_name)(df)
    part = SP.take_part(adapted, data_split, phase - 1, key_cols, seed)
    kept = AD.drop_null_sides(part, phase)
    if phase == 1:
        enc = EN.fixed_length(kept, "prompt_and_chosen", max_seq, eoc_token, tokenizer)
        return EN.phase_record(enc, 1)
    if phase == 2:
        enc = EN.fixed_length(kept, "prompt_and_chosen", max_seq, eoc_token, tokenizer, prefix="chosen_")
        enc = EN.fixed_length(enc, "prompt_and_rejected", max_seq, eoc_token, tokenizer, prefix="rejected_")
        return EN.phase_record(enc, 2)
    enc = EN.prompt_left_pad(kept, "prompt", max_seq, max_seq, tokenizer)
    return EN.phase_record(enc, 3, tokenizer.pad_id)


def create_dataset(train: DataFrame, eval_: DataFrame, dataset_name: str, phase: int, data_split: str,
                   key_cols: list[str], seed: int = 1234, eoc_token: str = "<|endoftext|>", max_seq: int = 512,
                   tokenizer=DEFAULT_TOKENIZER) -> tuple[DataFrame, DataFrame]:
    """(train, eval) records of ``phase`` for one preference source."""
    return (create_split(train, dataset_name, phase, data_split, key_cols, seed, eoc_token, max_seq, tokenizer),
            create_split(eval_, dataset_name, phase, data_split, key_cols, seed, eoc_token, max_seq, tokenizer))

