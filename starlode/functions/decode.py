"""Codes and flags -> business labels."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from starlode.functions.text import _col

# Labels of the evaluation status.
STATUS_LABELS = {
    1: "NÃO INICIADO",
    2: "EM ANDAMENTO",
    3: "EM ANÁLISE",
    4: "REPROVADO",
    5: "REABERTO",
    6: "CONCLUÍDO",
}
STATUS_UNKNOWN = "DESCONHECIDO"
# Labels of the platform an evaluation was made on.
PLATFORM_LABELS = {1: "WEB", 2: "ANDROID", 3: "IOS"}
PLATFORM_UNKNOWN = "DESCONHECIDA"


def label_of(code: Column, labels: Mapping[int, str], unknown: str) -> Column:
    """Label of an integer code; null and unlisted codes give ``unknown``."""
    arms = [F.when(code == value, label) for value, label in labels.items()]
    return F.coalesce(*arms, F.lit(unknown))


def status_label(code: Column | str) -> Column:
    return label_of(_col(code), STATUS_LABELS, STATUS_UNKNOWN)


def platform_label(code: Column | str) -> Column:
    """Platform codes arrive as text; what is not a number counts as unknown."""
    return label_of(_col(code).try_cast("int"), PLATFORM_LABELS, PLATFORM_UNKNOWN)


def deletion_label(deleted_at: Column | str, kept: str = "Ativo", deleted: str = "Inativo") -> Column:
    return F.when(_col(deleted_at).isNotNull(), deleted).otherwise(kept)


def yes_no(flag: Column | str) -> Column:
    """``SIM`` for true, ``NÃO`` for false and null."""
    return F.when(_col(flag), "SIM").otherwise("NÃO")
