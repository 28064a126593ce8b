"""The knobs of curation and their defaults."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class CurationConfig:
    embed_dim: int = 1024
    embed_batch_size: int = 96
    quality_threshold: float = 0.5
    dedup_cosine_threshold: float = 0.90
    minhash_num_perm: int = 128
    minhash_shingle_size: int = 5
    lsh_band_rows: int = 1
    dedup_surface_threshold: float = 0.5
    min_chars: int = 200
    max_chars: int = 100_000
    max_symbol_ratio: float = 0.10
    min_mean_line: float = 20.0
    target_language: str = "en"
    sample_size: int = 200_000
    partitions: int = 4
    flush_size: int = 256
    reject_every: int = 10


DEFAULT = CurationConfig()
