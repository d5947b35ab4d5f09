"""What language models return: gates, merges and types of extracted fields."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from prumo.functions import values

#: Degrees of confidence that count.
TRUSTED = ("alta", "media")


def accepted(reply: Column, asked: Column, fields: dict[str, str]) -> dict[str, Column]:
    """Fields of a JSON reply, typed: null unless the reply's confidence is trusted and the field was asked for; values that
    don't fit the type (such as an impossible date) are dropped. asked: array of field names."""
    sure = F.coalesce(F.get_json_object(reply, "$.confianca").isin(*TRUSTED), F.lit(False))
    return {name: F.when(sure & F.array_contains(asked, name), F.get_json_object(reply, f"$.{name}").try_cast(kind)) for name, kind in fields.items()}


def filled(current: dict[str, Column], *sources: dict[str, Column]) -> dict[str, Column]:
    """Known values stay; nulls take the first source that has one. A field that no source may set keeps its value."""
    return {name: F.coalesce(value, *(s[name] for s in sources if name in s)) for name, value in current.items()}


def as_list(reply: Column, schema: str) -> Column:
    """Records of a JSON reply whatever its shape: a list, an object that holds one under 'vagas', or one object."""
    kind = F.substring(F.ltrim(reply), 1, 1)
    one = f"array<struct<{schema}>>"
    inner = F.from_json(reply, f"vagas {one}")["vagas"]
    return F.when(kind == "[", F.from_json(reply, one)).when(inner.isNotNull(), inner).when(kind == "{", F.array(F.from_json(reply, schema))).otherwise(F.array().cast(one))


def typed(of: Column, path: str, kind: str) -> Column:
    """The value at a path of a variant, as a type; null where there is none or it doesn't fit. Numbers may come as text."""
    own = F.try_variant_get(of, path, kind)
    return own if kind == "string" else F.coalesce(own, F.try_variant_get(of, path, "string").try_cast(kind))


def records_of(reply: Column, field: str) -> Column:
    """Records of a JSON reply as an array of variants, whatever its shape: a list, an object with a list under a field (as JSON or as a text
    of JSON), or one object; null for what is no JSON."""
    whole = F.try_parse_json(reply)
    inner = F.try_variant_get(whole, f"$.{field}", "array<variant>")
    said = F.try_variant_get(F.try_parse_json(F.try_variant_get(whole, f"$.{field}", "string")), "$", "array<variant>")
    return F.coalesce(F.try_variant_get(whole, "$", "array<variant>"), inner, said, F.when(whole.isNotNull() & F.try_variant_get(whole, f"$.{field}", "variant").isNull(), F.array(whole)))


def vacancy_fields(reply: Column, role: int = 0) -> dict[str, Column]:
    """The named fields of a record from a reply with those of the notice and, in its list 'vagas', of its roles: counts from numbers or
    texts, dates only in ISO form, and the value of an hour worked out from monthly pay and a plain weekly load."""
    notice = F.try_parse_json(reply)
    own = F.get(records_of(reply, "vagas"), F.lit(role))
    pay, load = typed(own, "$.salario", "decimal(12,2)"), typed(own, "$.carga_horaria", "string")
    out = {
        "numero_vagas": values.parse_count(typed(own, "$.vagas_qtd", "string")),
        "taxa_inscricao": typed(notice, "$.taxa_inscricao", "decimal(12,2)"),
        "carga_horaria": load,
        "valor_hora": values.hourly_of(pay, typed(own, "$.salario_tipo", "string"), load).cast("decimal(12,2)"),
        "requisitos": typed(own, "$.requisitos", "string"),
        "banca_organizadora": typed(notice, "$.banca_organizadora", "string"),
        "tem_prova": typed(notice, "$.tem_prova", "boolean"),
        "exige_curriculo": typed(notice, "$.exige_curriculo", "boolean"),
    }
    return out | {name: values.date_iso(typed(notice, f"$.{name}", "string")) for name in ("data_prova", "data_pagamento_taxa", "data_resultado")}


def list_or_text(reply: Column, field: str, schema: str) -> Column:
    """An array field that some replies hold as JSON and others as a text of JSON."""
    one = f"array<struct<{schema}>>"
    return F.coalesce(F.from_json(reply, f"{field} {one}")[field], F.from_json(F.get_json_object(reply, f"$.{field}"), one))


def json_schema(fields: T.StructType) -> dict:
    """The JSON Schema of a struct: every field required, each one nullable."""
    kinds = {T.StringType: "string", T.BooleanType: "boolean", T.IntegerType: "integer", T.LongType: "integer", T.DoubleType: "number", T.DecimalType: "number", T.DateType: "string"}

    def of(kind: T.DataType) -> dict:
        if isinstance(kind, T.StructType):
            return json_schema(kind)
        if isinstance(kind, T.ArrayType):
            return {"type": "array", "items": of(kind.elementType)}
        out: dict = {"type": [kinds[type(kind)], "null"]}
        return {**out, "format": "date"} if isinstance(kind, T.DateType) else out

    return {"type": "object", "properties": {f.name: of(f.dataType) for f in fields}, "required": [f.name for f in fields], "additionalProperties": False}
