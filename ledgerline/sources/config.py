"""Configuration: YAML read and checked on the driver, then small dimension
tables. Every loader fails fast and names the offending entry."""

from __future__ import annotations

from dataclasses import dataclass
from decimal import Decimal
from pathlib import Path

import yaml
from pyspark.sql import DataFrame, SparkSession

from ..errors import ConfigError
from ..functions.numbers import LOCALES, SCALES
from ..plans import schema as S

CONFIG = Path(__file__).resolve().parent.parent / "config"
AUTO_ACCEPT = Decimal("0.95")


def _read(path: Path) -> dict:
    if not path.exists():
        raise ConfigError(f"{path}: no such configuration")
    data = yaml.safe_load(path.read_text(encoding="utf-8"))
    if not isinstance(data, dict):
        raise ConfigError(f"{path}: a mapping is expected")
    return data


def _one_of(value: object, known, where: str) -> str:
    if str(value) not in known:
        raise ConfigError(f"{where}: {value!r} is none of {', '.join(known)}")
    return str(value)


def _need(entry: dict, keys: list[str], where: str) -> list:
    if missing := [k for k in keys if entry.get(k) is None]:
        raise ConfigError(f"{where}: {', '.join(missing)} missing")
    return [entry[k] for k in keys]


def load_banks(path: Path = CONFIG / "banks.yaml") -> list[dict]:
    out, seen = [], set()
    for i, b in enumerate(_read(path).get("banks") or []):
        where = f"{path.name} entry {i} ({b.get('id')})"
        id_, name, jurisdiction, url, locale, currency = _need(b, ["id", "name", "jurisdiction", "ir_url", "number_locale", "reporting_currency"], where)
        if id_ in seen:
            raise ConfigError(f"{where}: id repeats")
        seen.add(id_)
        scale = b.get("monetary_scale", "millions")
        out.append({"bank": id_, "name": name, "jurisdiction": _one_of(jurisdiction, S.JURISDICTIONS, where), "ir_url": url, "lei": b.get("lei"), "number_locale": _one_of(locale, LOCALES, where), "reporting_currency": currency, "monetary_scale": _one_of(scale, SCALES, where)})
    if not out:
        raise ConfigError(f"{path.name}: no banks")
    return out


def banks(spark: SparkSession, path: Path = CONFIG / "banks.yaml") -> DataFrame:
    return spark.createDataFrame(load_banks(path), "bank string, name string, jurisdiction string, ir_url string, lei string, number_locale string, reporting_currency string, monetary_scale string")


def load_template(template: str, folder: Path = CONFIG / "templates") -> list[dict]:
    _one_of(template, S.TEMPLATES, "template")
    path = folder / f"{template.lower()}.yaml"
    data = _read(path)
    if data.get("template") != template:
        raise ConfigError(f"{path.name}: template is {data.get('template')!r}")
    out, codes = [], set()
    for i, f in enumerate(data.get("fields") or []):
        where = f"{path.name} field {i} ({f.get('code')})"
        code, kind, ecl, floor, aliases = _need(f, ["code", "kind", "ecl", "floor", "aliases"], where)
        if code in codes:
            raise ConfigError(f"{where}: code repeats")
        if not isinstance(aliases, list) or not all(isinstance(a, str) and a.strip() for a in aliases) or not aliases:
            raise ConfigError(f"{where}: aliases must be a list of texts")
        codes.add(code)
        out.append({"template": template, "code": code, "field_ord": i, "kind": _one_of(kind, S.KINDS, where), "ecl": _one_of(ecl, S.ECL_BASES, where), "floor": _one_of(floor, S.FLOOR_BASES, where), "aliases": aliases})
    if not out:
        raise ConfigError(f"{path.name}: no fields")
    return out


def template_fields(spark: SparkSession, *templates: str, folder: Path = CONFIG / "templates") -> DataFrame:
    """(template, code, field_ord, kind, ecl, floor, aliases in order)."""
    rows = [f for t in templates for f in load_template(t, folder)]
    return spark.createDataFrame(rows, "template string, code string, field_ord int, kind string, ecl string, floor string, aliases array<string>")


def load_identities(path: Path = CONFIG / "identities.yaml") -> list[dict]:
    """Long rows: one per operand of each identity."""
    out = []
    for template, section in _read(path).items():
        _one_of(template, S.TEMPLATES, path.name)
        for kind, roles in (("ratio_identities", ["ratio", "numerator", "denominator"]), ("cross_foots", ["total", "components"])):
            for i, identity in enumerate((section or {}).get(kind) or []):
                where = f"{path.name} {template} {kind} {i}"
                for role, operand in zip(roles, _need(identity, roles, where)):
                    operands = operand if isinstance(operand, list) else [operand]
                    if not operands:
                        raise ConfigError(f"{where}: {role} is empty")
                    for k, o in enumerate(operands):
                        code, ecl, floor = _need(o, ["code", "ecl", "floor"], f"{where} {role}")
                        out.append({"template": template, "identity": f"{template}/{kind}/{i}", "kind": "RATIO_IDENTITY" if kind[0] == "r" else "CROSS_FOOT", "role": role, "operand_ord": k, "code": code, "ecl": _one_of(ecl, S.ECL_BASES, where), "floor": _one_of(floor, S.FLOOR_BASES, where), "factor": Decimal(str(identity.get("factor", 100)))})
    return out


def identity_operands(spark: SparkSession, path: Path = CONFIG / "identities.yaml") -> DataFrame:
    return spark.createDataFrame(load_identities(path), f"template string, identity string, kind string, role string, operand_ord int, code string, ecl string, floor string, factor {S.COMPUTE}")


@dataclass(frozen=True)
class Tolerances:
    ratio_bp: Decimal
    foot_abs: Decimal
    foot_rel: Decimal
    engine_abs: Decimal
    engine_rel: Decimal


@dataclass(frozen=True)
class Weights:
    passed: Decimal
    skip: Decimal
    unchecked: Decimal
    ratio_identity_fail: Decimal
    cross_foot_fail: Decimal
    two_engine_fail: Decimal
    magnitude_sanity_fail: Decimal


def load_tolerances(path: Path = CONFIG / "reconciliation.yaml") -> Tolerances:
    t = _need(_read(path), ["tolerances"], path.name)[0]
    ratio, foot, engine = _need(t, ["ratio_identity", "cross_foot", "two_engine"], path.name)
    bp = _need(ratio, ["bp"], f"{path.name} ratio_identity")
    values = bp + _need(foot, ["abs", "rel"], f"{path.name} cross_foot") + _need(engine, ["abs", "rel"], f"{path.name} two_engine")
    numbers = [Decimal(str(v)) for v in values]
    if any(n < 0 for n in numbers):
        raise ConfigError(f"{path.name}: tolerances must not be negative")
    return Tolerances(*numbers)


def load_weights(path: Path = CONFIG / "reconciliation.yaml") -> Weights:
    c = _need(_read(path), ["confidence"], path.name)[0]
    keys = ["pass", "skip", "unchecked", "ratio_identity_fail", "cross_foot_fail", "two_engine_fail", "magnitude_sanity_fail"]
    return Weights(*[Decimal(str(v)) for v in _need(c, keys, f"{path.name} confidence")])


def load_bands(path: Path = CONFIG / "magnitude_bands.yaml") -> list[dict]:
    out = []
    for template, classes in _read(path).items():
        for name, band in (classes or {}).items():
            low, high = (Decimal(str(v)) for v in _need(band, ["min", "max"], f"{path.name} {template} {name}"))
            if low > high:
                raise ConfigError(f"{path.name} {template} {name}: min above max")
            out.append({"template": _one_of(template, S.TEMPLATES, path.name), "unit_class": _one_of(name, ["monetary", "percent", "ratio"], path.name), "low": low, "high": high})
    return out


def magnitude_bands(spark: SparkSession, path: Path = CONFIG / "magnitude_bands.yaml") -> DataFrame:
    return spark.createDataFrame(load_bands(path), f"template string, unit_class string, low {S.COMPUTE}, high {S.COMPUTE}")


def load_datapoints(path: Path = CONFIG / "datapoints_km1.yaml") -> list[dict]:
    data, out, seen = _read(path), [], set()
    for i, d in enumerate(data.get("datapoints") or []):
        where = f"{path.name} entry {i}"
        point, code, stored = _need(d, ["datapoint", "field_code", "stored_as"], where)
        if point in seen:
            raise ConfigError(f"{where}: {point} repeats")
        seen.add(point)
        out.append({"template": data.get("template"), "datapoint": point, "field_code": code, "stored_as": _one_of(stored, S.STORED_AS, where)})
    if not out:
        raise ConfigError(f"{path.name}: no datapoints")
    return out


def datapoint_map(spark: SparkSession, path: Path = CONFIG / "datapoints_km1.yaml") -> DataFrame:
    return spark.createDataFrame(load_datapoints(path), "template string, datapoint string, field_code string, stored_as string")
