"""Settings of the capture pipeline and the two named profiles."""

from __future__ import annotations

import json
import tomllib
from collections.abc import Mapping
from dataclasses import dataclass, field, fields, replace


@dataclass(frozen=True)
class FieldRule:
    """Clean-up of one output field; -1 means no bound and 0 discards the field."""

    max_length: int = -1
    max_values: int = -1
    rewrites: tuple[tuple[str, str], ...] = ()
    control_to_space: bool = True
    repair_utf8: bool = True
    squeeze: bool = True


@dataclass(frozen=True)
class Config:
    record_types: tuple[str, ...] = ("response", "resource", "revisit")
    protocols: tuple[str, ...] = ("http", "https")
    response_codes: tuple[str, ...] = ("2",)
    url_excludes: tuple[str, ...] = ()
    normalise_links: bool = False
    linked_resources: bool = False
    hash_stage: str = "after_dechunk_before_decompression"
    xml_root: bool = False
    images: bool = False
    max_image: int = 10 << 20
    image_sampling: int = 1
    first_bytes: bool = False
    n_first_bytes: int = 32
    postcodes: bool = True
    sentiment: bool = False
    fuzzy_hash: bool = False
    language: bool = True
    keep_text: bool = True
    max_text: int = 512 * 1024
    fields: dict[str, FieldRule] = field(default_factory=lambda: {"url": FieldRule(max_length=2000), "url_norm": FieldRule(max_length=2000, rewrites=((r"%20[0-9.]+[wx]$", ""),)), "content": FieldRule(max_length=512 * 1024)})

    def rule(self, name: str) -> FieldRule:
        return self.fields.get(name, FieldRule())


DEFAULT = Config()
DATASET = replace(DEFAULT, record_types=(), response_codes=(), first_bytes=True, linked_resources=True)
PROFILES = {"default": DEFAULT, "dataset": DATASET}


def load(values: Mapping[str, object], base: Config = DEFAULT) -> Config:
    """base with the settings of a mapping; field rules are mappings too. A setting that there isn't is an error."""
    known = {f.name for f in fields(Config)}
    if extra := sorted(set(values) - known):
        raise ValueError(f"no such setting: {', '.join(extra)}")
    out: dict[str, object] = {k: tuple(v) if isinstance(v, list) else v for k, v in values.items() if k != "fields"}
    if "fields" in values:
        rules = {name: FieldRule(**{k: tuple(map(tuple, v)) if k == "rewrites" else v for k, v in rule.items()}) for name, rule in values["fields"].items()}
        out["fields"] = {**base.fields, **rules}
    return replace(base, **out)


def read(path: str) -> Config:
    """Settings of a JSON or TOML file on the driver; ``profile`` names what they start from."""
    with open(path, "rb") as f:
        values = tomllib.load(f) if path.endswith(".toml") else json.load(f)
    return load(values, PROFILES[values.pop("profile", "default")])


def lines(config: Config) -> list[str]:
    """The settings as sorted ``name = value`` lines."""
    return sorted(f"{k} = {v!r}" for k, v in vars(config).items())
