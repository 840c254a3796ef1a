"""The entities of the checklist domain."""

from __future__ import annotations

from starlode.functions import (
    blank_to,
    digits_only,
    empty_list_to,
    empty_to,
    empty_to_upper,
    null_to_upper,
    postal_code,
    state_or_extracted,
    trim_lower,
    trim_upper,
    zero_fill,
)
from starlode.operators.conform import EntitySpec

# The published default texts.
NOT_INFORMED = "NÃO INFORMADO"
NOT_SHARED = "NÃO COMPARTILHADO"
NO_ANSWER = "SEM RESPOSTA"
NO_COMMENT = "SEM COMENTÁRIO"


# Columns and types of the Silver tables, in table order.
CHECKLISTS = {
    "checklistId": "bigint",
    "type": "string",
    "name": "string",
    "subject": "string",
    "description": "string",
    "active": "boolean",
    "createdAt": "timestamp",
    "updatedAt": "timestamp",
    "deletedAt": "timestamp",
}
CATEGORIES = {
    "categoryId": "bigint",
    "checklistId": "bigint",
    "parentId": "bigint",
    "type": "int",
    "name": "string",
    "description": "string",
    "createdAt": "timestamp",
    "updatedAt": "timestamp",
    "deletedAt": "timestamp",
}
ITEMS = {
    "itemId": "bigint",
    "checklistId": "bigint",
    "categoryId": "bigint",
    "name": "string",
    "deletedAt": "timestamp",
    "order": "int",
}
UNITS = {
    "unitId": "bigint",
    "name": "string",
    "email": "string",
    "active": "boolean",
    "unitTypeId": "bigint",
    "zipCode": "string",
    "address": "string",
    "number": "string",
    "complement": "string",
    "countryId": "int",
    "stateId": "string",
    "cityId": "int",
    "latitude": "double",
    "longitude": "double",
    "createdAt": "timestamp",
    "updatedAt": "timestamp",
    "deletedAt": "timestamp",
}
USERS = {
    "userId": "bigint",
    "name": "string",
    "email": "string",
    "active": "boolean",
    "userTypeId": "bigint",
    "phone": "string",
    "languageId": "int",
    "countryId": "int",
    "stateId": "int",
    "createdAt": "timestamp",
    "updatedAt": "timestamp",
    "deletedAt": "timestamp",
}
USER_TYPES = {
    "userTypeId": "bigint",
    "name": "string",
    "active": "boolean",
    "createdAt": "timestamp",
    "updatedAt": "timestamp",
    "deletedAt": "timestamp",
}
EVALUATIONS = {
    "evaluationId": "bigint",
    "status": "int",
    "score": "decimal(10,2)",
    "checklistId": "bigint",
    "unitId": "bigint",
    "userId": "bigint",
    "startedAt": "timestamp",
    "concludedAt": "timestamp",
    "approvedAt": "timestamp",
    "platform": "string",
    "scheduled": "boolean",
    "scheduleStartDate": "timestamp",
    "scheduleEndDate": "timestamp",
    "finalComment": "string",
    "sharedTo": "string",
    "countAttachments": "int",
    "initialLatitude": "double",
    "initialLongitude": "double",
    "finalLatitude": "double",
    "finalLongitude": "double",
    "createdAt": "timestamp",
    "updatedAt": "timestamp",
    "deletedAt": "timestamp",
}
EVALUATIONS_RESULTS = {
    "resultId": "bigint",
    "evaluationId": "bigint",
    "categoryId": "bigint",
    "itemId": "bigint",
    "scaleId": "bigint",
    "answeredAt": "timestamp",
    "evaluative": "int",
    "sharedTo": "string",
    "text": "string",
    "number": "double",
    "stateId": "int",
    "cityId": "int",
    "product": "string",
    "competencePeriodId": "bigint",
    "selectedOptions": "string",
    "index": "int",
    "originalWeight": "decimal(10,2)",
    "maximumWeight": "decimal(10,2)",
    "obtainedWeight": "decimal(10,2)",
    "comment": "string",
    "countAttachments": "int",
    "countSignatures": "int",
    "itemOrder": "int",
    "categoryOrder": "int",
}

SILVER = {
    spec.name: spec
    for spec in (
        EntitySpec(
            "checklists",
            "checklistId",
            CHECKLISTS,
            version="updatedAt",
            watermark="updatedAt",
            rules={
                "name": trim_upper,
                "subject": lambda c: null_to_upper(c, NOT_INFORMED),
                "description": lambda c: blank_to(c, NOT_INFORMED),
            },
        ),
        EntitySpec(
            "categories",
            "categoryId",
            CATEGORIES,
            version="updatedAt",
            watermark="updatedAt",
            rules={"name": trim_upper},
        ),
        EntitySpec("items", "itemId", ITEMS, rules={"name": trim_upper}),
        EntitySpec(
            "units",
            "unitId",
            UNITS,
            version="updatedAt",
            watermark="updatedAt",
            rules={
                "zipCode": lambda _: postal_code("address"),
                "stateId": lambda c: state_or_extracted(c, "address"),
            },
        ),
        EntitySpec(
            "users",
            "userId",
            USERS,
            version="updatedAt",
            watermark="updatedAt",
            rules={"name": trim_upper, "email": trim_lower, "phone": digits_only},
        ),
        EntitySpec(
            "user_types",
            "userTypeId",
            USER_TYPES,
            version="updatedAt",
            watermark="updatedAt",
            rules={"name": trim_upper},
        ),
        EntitySpec(
            "evaluations",
            "evaluationId",
            EVALUATIONS,
            version="updatedAt",
            watermark="updatedAt",
            rules=dict.fromkeys(
                ("finalComment", "sharedTo"), lambda c: empty_to_upper(c, NOT_INFORMED)
            ),
        ),
        EntitySpec(
            "evaluations_results",
            "resultId",
            EVALUATIONS_RESULTS,
            version="answeredAt",
            watermark="answeredAt",
            parent="evaluationId",
            tolerant=frozenset({"evaluative"}),
            rules={
                **dict.fromkeys(
                    (
                        "evaluative",
                        "number",
                        "index",
                        "originalWeight",
                        "maximumWeight",
                        "obtainedWeight",
                        "countAttachments",
                        "countSignatures",
                    ),
                    zero_fill,
                ),
                "sharedTo": lambda c: empty_to(c, NOT_SHARED),
                "text": lambda c: empty_to(c, NO_ANSWER),
                "selectedOptions": lambda c: empty_list_to(c, NOT_INFORMED),
                "comment": lambda c: empty_to(c, NO_COMMENT),
            },
        ),
    )
}

# Entities that stop at Bronze. Their columns are not declared: a record is kept as a map.
BRONZE_ONLY = {
    spec.name: spec
    for spec in (
        EntitySpec("countries"),
        EntitySpec("evaluations_history", "evaluationId", watermark="date", stamped=False),
        EntitySpec("evaluations_departments", watermark="date", stamped=False),
    )
}

ENTITIES = SILVER | BRONZE_ONLY
