"""Settings of a curation run, read from YAML once and checked: an unknown, missing or mistyped key is an error."""

from __future__ import annotations

import typing
from dataclasses import dataclass, field, fields, is_dataclass
from functools import lru_cache

from quernstone.operators.rules import Limits


@dataclass(frozen=True)
class Audio:
    asr_sample_rate: int
    master_sample_rate: int
    channels: int


@dataclass(frozen=True)
class Segmentation:
    min_duration_s: float
    max_duration_s: float
    target_min_s: float
    target_max_s: float
    silence_top_db: float
    min_silence_gap_s: float
    edge_pad_s: float
    merge_gap_s: float


@dataclass(frozen=True)
class Quality:
    max_clipped_fraction: float
    min_snr_db: float
    max_silence_ratio: float
    min_language_probability: float
    max_gap_energy_ratio: float
    min_chars_per_sec: float
    max_chars_per_sec: float
    dedup_similarity: float


@dataclass(frozen=True)
class Asr:
    batch_model: str
    batch_mode: str
    batch_timeout_s: int
    realtime_model: str


@dataclass(frozen=True)
class Llm:
    model: str
    temperature: float
    max_tokens: int


@dataclass(frozen=True)
class Whisper:
    max_voiced_fraction: float
    max_energy_zscore: float
    max_hnr_db: float


@dataclass(frozen=True)
class Emotion:
    emotions: tuple[str, ...]
    styles: tuple[str, ...]
    low_confidence_threshold: float
    whisper: Whisper


@dataclass(frozen=True)
class Targets:
    minutes_per_language: float
    val_fraction: float
    prefer_topics: tuple[str, ...] = ()


@dataclass(frozen=True)
class Language:
    code: str
    name: str
    config: str


@dataclass(frozen=True)
class Dataset:
    license: str


@dataclass(frozen=True)
class Settings:
    audio: Audio
    segmentation: Segmentation
    quality: Quality
    asr: Asr
    llm: Llm
    emotion: Emotion
    targets: Targets
    languages: dict[str, Language]
    dataset: Dataset = field(default=Dataset("unknown"))

    def limits(self) -> Limits:
        """The gates' limits."""
        q, s = self.quality, self.segmentation
        return Limits(q.max_clipped_fraction, q.min_snr_db, q.max_silence_ratio, q.min_chars_per_sec, q.max_chars_per_sec, s.min_duration_s, s.max_duration_s, q.min_language_probability, q.max_gap_energy_ratio)


def checked(kind, value, where: str):
    """value as kind, a dataclass, tuple, dict or scalar."""
    if is_dataclass(kind):
        if not isinstance(value, dict):
            raise ValueError(f"{where}: a section is expected")
        hints, known = typing.get_type_hints(kind), {f.name: f for f in fields(kind)}
        if extra := sorted(set(value) - set(known)):
            raise ValueError(f"{where}: unknown {', '.join(extra)}")
        given = {n: checked(hints[n], v, f"{where}.{n}".lstrip(".")) for n, v in value.items()}
        try:
            return kind(**given)
        except TypeError as e:
            raise ValueError(f"{where or 'settings'}: {e}") from None
    origin, args = typing.get_origin(kind), typing.get_args(kind)
    if origin is tuple:
        if not isinstance(value, list):
            raise ValueError(f"{where}: a list is expected")
        return tuple(checked(args[0], v, where) for v in value)
    if origin is dict:
        if not isinstance(value, dict):
            raise ValueError(f"{where}: a section is expected")
        return {str(k): checked(args[1], v, f"{where}.{k}") for k, v in value.items()}
    if isinstance(value, bool) or not isinstance(value, (int, float) if kind is float else kind):
        raise ValueError(f"{where}: {kind.__name__} is expected, not {value!r}")
    return kind(value)


def parsed(text: str) -> Settings:
    import yaml

    return checked(Settings, yaml.safe_load(text) or {}, "")


@lru_cache(maxsize=8)
def load(path: str) -> Settings:
    """The settings of a file on the driver, read once."""
    with open(path, encoding="utf-8") as f:
        return parsed(f.read())
