"""Settings read from environment variables, with bounds."""

from __future__ import annotations

import json
import os
from collections.abc import Mapping
from dataclasses import asdict, dataclass, fields


def _number(env: Mapping[str, str], name: str, default, least):
    raw = env.get(name)
    if raw is None or not raw.strip():
        return default
    try:
        value = type(default)(raw)
    except ValueError as e:
        raise ValueError(f"{name} must be a number, not {raw!r}") from e
    if value < least:
        raise ValueError(f"{name} must be >= {least}")
    return value


def _flag(env: Mapping[str, str], name: str, default: bool) -> bool:
    raw = env.get(name)
    return default if raw is None else raw.strip().lower() in {"1", "true", "yes"}


@dataclass(frozen=True)
class Settings:
    """Parameters of ingestion and recognition. Environment names are the field names in capitals."""

    input_prefix: str = "incoming/"
    tmp_prefix: str = "tmp"
    result_prefix: str = "result"
    ocr_strict_memory_mode: bool = False
    ocr_max_concurrent: int = 5
    ocr_batch_size: int = 10
    ocr_chunk_size: int = 50
    ocr_dpi: int = 100
    ocr_jpeg_quality: int = 80
    ocr_submit_rps: float = 8.0
    ocr_poll_rps: float = 40.0
    ocr_max_batch_bytes: int = 9_000_000
    ocr_max_failed_pages: int = 0

    @classmethod
    def from_env(cls, env: Mapping[str, str] | None = None) -> Settings:
        env = os.environ if env is None else env
        least = {"ocr_submit_rps": 0.0, "ocr_poll_rps": 0.0, "ocr_max_batch_bytes": 100_000, "ocr_max_failed_pages": 0}
        out = {}
        for f in fields(cls):
            name = f.name.upper()
            if isinstance(f.default, bool):
                out[f.name] = _flag(env, name, f.default)
            elif isinstance(f.default, str):
                out[f.name] = env.get(name, f.default)
            else:
                out[f.name] = _number(env, name, f.default, least.get(f.name, 1))
        return cls(**out)

    @property
    def tasks(self) -> int:
        """Parallel recognition tasks: one in strict mode."""
        return 1 if self.ocr_strict_memory_mode else self.ocr_max_concurrent

    def to_json(self) -> str:
        return json.dumps(asdict(self), sort_keys=True)
