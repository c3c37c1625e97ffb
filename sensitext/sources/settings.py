"""Tokenizer settings, vocabularies and label maps from configuration files."""

from __future__ import annotations

import json
import os
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession, functions as F

from sensitext.constants import ID2LABEL, MODEL_MAX_LENGTH, SPECIAL_TOKENS, VOCAB_SIZE


@dataclass(frozen=True)
class TokenizerSettings:
    special_tokens: dict[str, int] = field(default_factory=lambda: dict(SPECIAL_TOKENS))
    do_lower_case: bool = False
    tokenize_chinese_chars: bool = True
    strip_accents: bool | None = None
    model_max_length: int = MODEL_MAX_LENGTH

    def longest(self, max_length: int) -> int:
        """The length asked for, or the model's where that is shorter."""
        return min(max_length, self.model_max_length)


def load_tokenizer_settings(spark: SparkSession, path: str) -> TokenizerSettings:
    """Settings from a ``tokenizer_config.json``.

    Settings the tokenizer of this package cannot honour raise an error rather than
    give other tokens than asked for.
    """
    raw = _read_json(spark, path)
    added = raw.get("added_tokens_decoder") or {}
    specials = {entry["content"]: int(i) for i, entry in added.items() if entry.get("special", True)}
    settings = TokenizerSettings(
        special_tokens=specials or dict(SPECIAL_TOKENS),
        do_lower_case=bool(raw.get("do_lower_case", False)),
        tokenize_chinese_chars=bool(raw.get("tokenize_chinese_chars", True)),
        strip_accents=raw.get("strip_accents"),
        model_max_length=int(raw.get("model_max_length", MODEL_MAX_LENGTH)),
    )
    if settings.do_lower_case or settings.strip_accents or not settings.tokenize_chinese_chars:
        raise ValueError("only cased tokenizing with CJK spacing is supported")
    if settings.special_tokens != SPECIAL_TOKENS:
        raise ValueError(f"special tokens must be {SPECIAL_TOKENS}")
    return settings


def load_vocab(spark: SparkSession, path: str, max_size: int = VOCAB_SIZE) -> DataFrame:
    """A ``vocab.txt`` with one token per line as ``token, id``; the line number is the id."""
    lines = [row.value for row in spark.read.text(path, wholetext=True).limit(2).collect()]
    if len(lines) > 1:
        raise ValueError(f"{path} holds more than one file; name the vocabulary file")
    tokens = lines[0].split("\n") if lines else []
    if tokens and tokens[-1] == "":
        tokens.pop()
    tokens = [t.removesuffix("\r") for t in tokens]
    if len(tokens) > max_size:
        raise ValueError(f"{len(tokens)} vocabulary entries, more than {max_size}")
    last_line = {token: i for i, token in enumerate(tokens)}
    return spark.createDataFrame(list(last_line.items()), "token string, id int")


def load_label_map(spark: SparkSession, config_json: str | None = None) -> dict[int, str]:
    """``id2label`` of a model configuration file, or the default map without a file."""
    if config_json is None:
        return dict(ID2LABEL)
    raw = _read_json(spark, config_json)
    if "id2label" not in raw:
        raise ValueError(f"{config_json} has no id2label")
    return {int(i): name for i, name in raw["id2label"].items()}


def _read_json(spark: SparkSession, path: str) -> dict:
    if os.path.isdir(path):
        raise ValueError(f"{path} is a folder; name the JSON file")
    rows = spark.read.text(path, wholetext=True).limit(2).collect()
    if not rows:
        raise ValueError(f"{path} is empty")
    if len(rows) > 1:
        raise ValueError(f"{path} holds more than one file; name the JSON file")
    return json.loads(rows[0].value)
