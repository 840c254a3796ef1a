"""Seven dimensions and two facts."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starlode.functions import (
    deletion_label,
    platform_label,
    status_label,
    surrogate_key,
    yes_no,
    zero_fill,
)
from starlode.operators.star import (
    DecodeSpec,
    DimensionLink,
    DimensionSpec,
    decode_dimension,
    dimension,
    link_dimensions,
)


#: Column of Silver rows that are not stored yet: it tells them apart, and they are partitioned by it.
ROW_KEY = "_row_key"


@dataclass(frozen=True)
class FactSpec:
    """A fact: its key, its links and its published columns (Silver name -> new name)."""

    name: str
    source: str
    key: str
    surrogate: str
    natural: str
    links: tuple[DimensionLink, ...]
    sk_order: tuple[str, ...]
    names: Mapping[str, str]
    rules: Mapping[str, Callable[[str], Column]] = field(default_factory=dict)


# Published column names of the dimensions and facts.
CHECKLIST_NAMES = {
    "checklistId": "id_original_checklist",
    "name": "nome_checklist",
    "subject": "assunto",
    "description": "descricao",
    "createdAt": "dt_criacao",
    "updatedAt": "dt_atualizacao",
    "deletedAt": "dt_delecao",
}
CHECKLIST_ORDER = (
    "id_original_checklist",
    "nome_checklist",
    "assunto",
    "descricao",
    "status_checklist",
    "dt_criacao",
    "dt_atualizacao",
    "dt_delecao",
)
UNIT_NAMES = {
    "unitId": "id_original_unidade",
    "name": "nome_unidade",
    "email": "email_unidade",
    "zipCode": "CEP",
    "address": "endereco",
    "number": "numero",
    "complement": "complemento",
    "stateId": "estado",
    "latitude": "latitude",
    "longitude": "longitude",
    "createdAt": "dt_criacao",
    "updatedAt": "dt_ultima_atualizacao",
    "deletedAt": "dt_delecao",
}
UNIT_ORDER = (
    "id_original_unidade",
    "nome_unidade",
    "email_unidade",
    "status_unidade",
    "CEP",
    "endereco",
    "numero",
    "complemento",
    "estado",
    "latitude",
    "longitude",
    "dt_criacao",
    "dt_ultima_atualizacao",
    "dt_delecao",
)
USER_NAMES = {
    "userId": "id_original_usuario",
    "name": "nome_usuario",
    "email": "email_usuario",
    "_typeName": "tipo_usuario",
    "phone": "telefone",
    "createdAt": "dt_criacao",
    "updatedAt": "dt_ultima_atualizacao",
    "deletedAt": "dt_delecao",
}
USER_ORDER = (
    "id_original_usuario",
    "nome_usuario",
    "email_usuario",
    "status_usuario",
    "tipo_usuario",
    "telefone",
    "dt_criacao",
    "dt_ultima_atualizacao",
    "dt_delecao",
)
CATEGORY_NAMES = {
    "categoryId": "id_original_categoria",
    "checklistId": "id_checklist",
    "parentId": "id_categoria_pai",
    "type": "tipo_categoria",
    "name": "nome_categoria",
    "description": "descricao_categoria",
    "createdAt": "dt_criacao",
    "updatedAt": "dt_atualizacao",
    "deletedAt": "dt_delecao",
}
ITEM_NAMES = {
    "itemId": "id_original_item",
    "checklistId": "id_checklist",
    "categoryId": "id_categoria",
    "name": "nome_item",
    "deletedAt": "dt_delecao",
    "order": "ordem_item",
}
APPLIED_NAMES = {
    "score": "pontuacao",
    "finalComment": "comentarios_finais",
    "sharedTo": "compartilhado_com",
    "countAttachments": "qtd_anexos",
    "scheduled": "agendado",
    "startedAt": "iniciado_em",
    "concludedAt": "concluido_em",
    "approvedAt": "aprovado_em",
    "scheduleStartDate": "dt_inicio_agendamento",
    "scheduleEndDate": "dt_fim_agendamento",
    "initialLatitude": "latitude_inicial",
    "initialLongitude": "longitude_inicial",
    "finalLatitude": "latitude_final",
    "finalLongitude": "longitude_final",
    "createdAt": "criado_em",
    "updatedAt": "atualizado_em",
    "deletedAt": "deletado_em",
}
RESULT_NAMES = {
    "scaleId": "id_escala",
    "answeredAt": "respondido_em",
    "evaluative": "avaliativo",
    "sharedTo": "compartilhado_com",
    "text": "texto_avaliacao",
    "number": "numero",
    "stateId": "id_estado",
    "cityId": "id_cidade",
    "product": "produto",
    "competencePeriodId": "id_competencia",
    "selectedOptions": "opcoes_selecionadas",
    "index": "indice",
    "originalWeight": "peso_original",
    "maximumWeight": "peso_maximo",
    "obtainedWeight": "peso_obtido",
    "comment": "comentario",
    "countAttachments": "qtd_anexos",
    "countSignatures": "qtd_assinaturas",
    "itemOrder": "ordem_item",
    "categoryOrder": "ordem_categoria",
}


DECODES = (
    DecodeSpec(
        "dim_status", "evaluations", "status",
        "sk_status", "id_original_status", "nome_status", status_label,
    ),
    DecodeSpec(
        "dim_plataforma", "evaluations", "platform",
        "sk_plataforma", "id_original_plataforma", "nome_plataforma", platform_label,
    ),
)

CURRENT_STATE = (
    DimensionSpec(
        "dim_checklists", "checklists", "checklistId", "sk_checklist", CHECKLIST_NAMES,
        {"status_checklist": lambda: deletion_label("deletedAt")},
        CHECKLIST_ORDER,
        "updatedAt",
    ),
    DimensionSpec(
        "dim_unidades", "units", "unitId", "sk_unidade", UNIT_NAMES,
        {"status_unidade": lambda: deletion_label("deletedAt", "Ativa", "Inativa")},
        UNIT_ORDER,
        "updatedAt",
    ),
    DimensionSpec(
        "dim_usuario", "users", "userId", "sk_usuario", USER_NAMES,
        {"status_usuario": lambda: deletion_label("deletedAt")},
        USER_ORDER,
        "updatedAt",
    ),
    DimensionSpec(
        "dim_categorias", "categories", "categoryId", "sk_categoria", CATEGORY_NAMES, newest=False
    ),
    DimensionSpec("dim_itens", "items", "itemId", "sk_item", ITEM_NAMES, newest=False),
)

DIMENSIONS = {spec.name: spec for spec in (*DECODES, *CURRENT_STATE)}

FACTS = {
    spec.name: spec
    for spec in (
        FactSpec(
            "fato_checklists_aplicados",
            "evaluations",
            "evaluationId",
            "sk_checklist_aplicado",
            "id_original_checklist_aplicado",
            (
                DimensionLink("dim_status", "status", "id_original_status", "sk_status"),
                DimensionLink(
                    "dim_plataforma", "platform", "id_original_plataforma", "sk_plataforma"
                ),
                DimensionLink(
                    "dim_checklists", "checklistId", "id_original_checklist", "sk_checklist"
                ),
                DimensionLink("dim_unidades", "unitId", "id_original_unidade", "sk_unidade"),
                DimensionLink("dim_usuario", "userId", "id_original_usuario", "sk_usuario"),
            ),
            ("sk_status", "sk_plataforma", "sk_checklist", "sk_unidade", "sk_usuario"),
            APPLIED_NAMES,
            {"score": zero_fill, "scheduled": yes_no},
        ),
        FactSpec(
            "fato_checklists_aplicados_resultados",
            "evaluations_results",
            "resultId",
            "sk_resultado",
            "id_original_resultado",
            (
                DimensionLink("dim_itens", "itemId", "id_original_item", "sk_item"),
                DimensionLink(
                    "dim_categorias", "categoryId", "id_original_categoria", "sk_categoria"
                ),
                DimensionLink(
                    "fato_checklists_aplicados",
                    "evaluationId",
                    "id_original_checklist_aplicado",
                    "sk_checklist_aplicado",
                ),
            ),
            ("sk_checklist_aplicado", "sk_categoria", "sk_item"),
            RESULT_NAMES,
        ),
    )
}


def gold_key(name: str) -> tuple[str, str]:
    """Natural and surrogate key column of a Gold table."""
    if name in FACTS:
        return FACTS[name].natural, FACTS[name].surrogate
    spec = DIMENSIONS[name]
    natural = spec.natural if isinstance(spec, DecodeSpec) else spec.names[spec.key]
    return natural, spec.surrogate


def linked_tables(fact: str) -> set[str]:
    """Gold tables that must exist before ``fact``."""
    return {link.dimension for link in FACTS[fact].links}


def with_type_name(users: DataFrame, user_types: DataFrame) -> DataFrame:
    """Users of a known type, with its name; the others drop out."""
    names = user_types.select("userTypeId", F.col("name").alias("_typeName"))
    return users.join(names, "userTypeId", "inner")


def build_dimension(
    name: str, silver: Callable[[str], DataFrame], method: str = "crc32", where: Column | None = None
) -> DataFrame:
    """Dimension ``name`` without audit column; ``silver`` gives Silver frames by entity."""
    spec = DIMENSIONS[name]
    if isinstance(spec, DecodeSpec):
        return decode_dimension(silver(spec.source), spec, method)
    enrich = None
    if name == "dim_usuario":
        enrich = lambda users: with_type_name(users, silver("user_types"))
    return dimension(silver(spec.source), spec, method, enrich, where)


def build_fact(
    name: str,
    silver: Callable[[str], DataFrame],
    gold: Callable[[str], DataFrame],
    method: str = "crc32",
) -> DataFrame:
    """Fact ``name`` without audit column; ``gold`` gives the frames it links to.

    A Silver frame with the column ``ROW_KEY`` is linked by it.
    """
    spec = FACTS[name]
    dims = {link.dimension: gold(link.dimension) for link in spec.links}
    rows = silver(spec.source)
    linked = link_dimensions(rows, spec.links, dims, ROW_KEY if ROW_KEY in rows.columns else None)
    return linked.select(
        surrogate_key(spec.key, method).alias(spec.surrogate),
        F.col(spec.key).alias(spec.natural),
        *spec.sk_order,
        *[spec.rules.get(old, F.col)(old).alias(new) for old, new in spec.names.items()],
    )


def build_gold(
    name: str,
    silver: Callable[[str], DataFrame],
    gold: Callable[[str], DataFrame],
    method: str = "crc32",
    where: Column | None = None,
) -> DataFrame:
    """``where`` leaves rows out of a current-state dimension."""
    if name in FACTS:
        return build_fact(name, silver, gold, method)
    return build_dimension(name, silver, method, where)
