"""Settings of whole runs: YAML or JSON files, with overrides of the caller in front."""

from __future__ import annotations

import json
from dataclasses import asdict, dataclass, field, fields
from typing import Any


@dataclass
class VariantSettings:
    """A run from variants to vectors."""

    vcf_path: str = ""
    bed_path: str = ""
    ref_fasta: str = ""
    output_dir: str = "outputs"
    flank: int = 200
    #: Bases of a sequence that an encoder sees; flanks must leave room for the variant.
    window_size: int = 128
    encoder: str = "toy"
    encoder_options: dict[str, Any] = field(default_factory=dict)
    pooling: str = "mean"
    output_format: str = "parquet"
    save_haplotypes: bool = True
    do_inference: bool = True
    save_embeddings: bool = True
    filter_hom_ref: bool = True

    def __post_init__(self) -> None:
        if self.pooling not in ("mean", "max"):
            raise ValueError(f"pooling is mean or max, not {self.pooling}")
        if not self.do_inference:
            self.save_embeddings = False


@dataclass
class OmicsSettings:
    """A run from vectors and tabular sources to models and their ablation."""

    embedding_path: str | None = None
    embedding_format: str = "json"
    metabolome_path: str | None = None
    phenome_path: str | None = None
    label_path: str = ""
    output_dir: str = "outputs_ml"
    id_column: str = "sample_id"
    label_column: str = "label"
    model_name: str | None = None
    strategy: str = "mut_hap1"
    select: str = "absolute"
    top_k: int = 0
    weight: float = 0.5
    widen: float = 3.0
    aggregate: str = "mean"
    impute: str = "median"
    components: int | str = "auto"
    folds: int = 5
    models: list[str] = field(default_factory=lambda: ["logistic"])
    grids: dict[str, dict[str, Any]] = field(default_factory=dict)
    modules: list[str] = field(default_factory=lambda: ["all"])
    seed: int = 42


def _parse(path: str) -> dict[str, Any]:
    with open(path, encoding="utf-8") as f:
        text = f.read()
    if path.endswith(".json"):
        return json.loads(text)
    try:
        import yaml
    except ImportError as missing:
        raise ValueError("reading YAML settings needs the yaml package; JSON works without") from missing
    return yaml.safe_load(text) or {}


def variant_settings(raw: dict[str, Any], **overrides: Any) -> VariantSettings:
    """An override that is not None wins; then section ``embedding``, the older ``output``, the top level, the default."""
    known = {f.name for f in fields(VariantSettings)}
    if extra := set(overrides) - known:
        raise ValueError(f"no settings {', '.join(sorted(extra))}")
    layers = [{"flank": raw.get("bed_split", {}).get("n"), "encoder": raw.get("model", {}).get("encoder")}, raw, raw.get("output") or {}, raw.get("embedding") or {}, overrides]
    merged = {k: v for layer in layers for k, v in layer.items() if k in known and v is not None}
    return VariantSettings(**merged)


def omics_settings(raw: dict[str, Any], **overrides: Any) -> OmicsSettings:
    """Sections (data, preprocess, cv, hyperparam, ablation, output) are only groups; unknown keys are refused."""
    known = {f.name for f in fields(OmicsSettings)}
    flat: dict[str, Any] = {}
    for key, value in raw.items():
        flat |= value if isinstance(value, dict) and key not in known else {key: value}
    flat |= {k: v for k, v in overrides.items() if v is not None}
    if extra := set(flat) - known:
        raise ValueError(f"no settings {', '.join(sorted(extra))}")
    return OmicsSettings(**flat)


def load_variant_settings(path: str, **overrides: Any) -> VariantSettings:
    return variant_settings(_parse(path), **overrides)


def load_omics_settings(path: str, **overrides: Any) -> OmicsSettings:
    return omics_settings(_parse(path), **overrides)


def save_settings(settings: VariantSettings | OmicsSettings, path: str) -> None:
    """A snapshot that load_* reads again; JSON, which is YAML too."""
    with open(path, "w", encoding="utf-8") as f:
        json.dump(asdict(settings), f, indent=2)
