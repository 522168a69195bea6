"""The event contract: an Avro record as a Spark schema, and an audit of messages against it."""

from __future__ import annotations

import json
from pathlib import Path

from pyspark.sql import Column, DataFrame, functions as F, types as T

# The fields of a clickstream event, in order.
REQUIRED_TEXT = ("event_id", "user_id", "session_id", "event_type", "page_url")
EVENT_TIME_FIELD = "timestamp"
OPTIONAL_TEXT = ("ip_address", "user_agent", "referrer", "country", "device_type")

# Avro's primitive types as Spark types. JSON messages carry bytes as text.
PRIMITIVES: dict[str, T.DataType] = {
    "boolean": T.BooleanType(), "int": T.IntegerType(), "long": T.LongType(), "float": T.FloatType(), "double": T.DoubleType(),
    "string": T.StringType(), "bytes": T.StringType(), "null": T.StringType(),
}
# Logical types whose number stands in JSON as it is.
NUMBERED = {"timestamp-millis", "timestamp-micros", "local-timestamp-millis", "local-timestamp-micros", "time-micros"}


def clickstream_contract() -> dict:
    """The clickstream event as an Avro record definition."""
    fields = [{"name": n, "type": "string"} for n in REQUIRED_TEXT]
    fields.append({"name": EVENT_TIME_FIELD, "type": "long", "logicalType": "timestamp-millis"})
    fields += [{"name": n, "type": ["null", "string"], "default": None} for n in OPTIONAL_TEXT]
    return {"type": "record", "name": "ClickstreamEvent", "fields": fields}


class AvroTypes:
    """Spark types of Avro schemas, as the Avro specification defines them.

    Named types (records, enums, fixed) may be referred to by full name, or by short name inside their
    namespace, once they are defined. ``exact`` gives dates, times, decimals and fixed-length values types of their
    own and refuses what has none; without it those are text, as is a name nobody defined. ``binary``: bytes as binary.
    """

    def __init__(self, binary: bool = False, exact: bool = False) -> None:
        self.binary, self.exact = binary, exact
        self.named: dict[str, T.DataType] = {}

    def of(self, schema: str | list | dict, space: str = "") -> T.DataType:
        if isinstance(schema, list):
            return self._union(schema, space)
        if isinstance(schema, str):
            return self._by_name(schema, space)
        kind = schema["type"]
        if isinstance(kind, (list, dict)):
            return self.of(kind, space)
        build = getattr(self, f"_{kind}", None)
        return self._logical(schema, space) if build is None else build(schema, space)

    def nullable(self, schema: str | list | dict) -> bool:
        return schema == "null" or isinstance(schema, list) and any(map(self.nullable, schema))

    def _unknown(self, what: str) -> T.DataType:
        if self.exact:
            raise ValueError(f"no Spark type for {what}")
        return T.StringType()

    def _by_name(self, name: str, space: str) -> T.DataType:
        if name == "bytes" and self.binary:
            return T.BinaryType()
        found = PRIMITIVES.get(name) or self.named.get(f"{space}.{name}") or self.named.get(name)
        return found or self._unknown(f"the name {name!r}")

    def _union(self, branches: list, space: str) -> T.DataType:
        kinds = [self.of(b, space) for b in branches if b != "null"]
        return kinds[0] if len(kinds) == 1 else self._unknown(f"a union of {len(kinds)} types")

    def _logical(self, schema: dict, space: str) -> T.DataType:
        logical = schema.get("logicalType")
        if logical in NUMBERED:
            return T.LongType()
        if logical and self.exact:
            wanted = {"date": T.DateType(), "time-millis": T.IntegerType(), "uuid": T.StringType()}.get(logical)
            if logical == "decimal":
                wanted = T.DecimalType(schema["precision"], schema.get("scale", 0))
            if wanted:
                return wanted
        return T.StringType() if logical in ("date", "decimal") else self._by_name(schema["type"], space)

    def _define(self, schema: dict, space: str, kind: T.DataType) -> T.DataType:
        own = schema.get("namespace", space)
        name = schema.get("name", "")
        self.named[name if "." in name or not own else f"{own}.{name}"] = kind
        return kind

    def _record(self, schema: dict, space: str) -> T.StructType:
        inside = schema.get("namespace") or schema.get("name", "").rpartition(".")[0] or space
        row = T.StructType()
        for field in schema.get("fields", []):
            # A logical type may also stand beside a field's type instead of inside it.
            kind = field if "logicalType" in field and isinstance(field["type"], str) else field["type"]
            row = row.add(field["name"], self.of(kind, inside), self.nullable(field["type"]))
        return self._define(schema, space, row)

    def _enum(self, schema: dict, space: str) -> T.DataType:
        return self._define(schema, space, T.StringType())

    def _fixed(self, schema: dict, space: str) -> T.DataType:
        exact = self._logical({**schema, "type": "bytes"}, space) if schema.get("logicalType") else T.BinaryType()
        return self._define(schema, space, exact if self.exact else T.StringType())

    def _array(self, schema: dict, space: str) -> T.DataType:
        return T.ArrayType(self.of(schema["items"], space), not self.exact or self.nullable(schema["items"]))

    def _map(self, schema: dict, space: str) -> T.DataType:
        return T.MapType(T.StringType(), self.of(schema["values"], space), not self.exact or self.nullable(schema["values"]))


def spark_type(avro: str | list | dict, binary: bool = False, exact: bool = False) -> T.DataType:
    return AvroTypes(binary, exact).of(avro)


def contract_schema(contract: str | Path | dict, binary: bool = False, exact: bool = False) -> T.StructType:
    """Spark schema of an Avro record, given as a parsed definition or an ``.avsc`` file; a registry
    wrapper holding the definition as text under ``schema`` is unwrapped."""
    definition = contract if isinstance(contract, dict) else json.loads(Path(contract).read_text())
    if "schema" in definition and "type" not in definition:
        definition = json.loads(definition["schema"])
    if definition.get("type") != "record":
        raise ValueError(f"a contract must be an Avro record, not {definition.get('type')!r}")
    return AvroTypes(binary, exact).of(definition)


def contract_audit(raw: DataFrame, schema: T.StructType) -> DataFrame:
    """How far decodable messages keep to the contract: per field how often it was missing, null or
    of the wrong type; for keys outside the contract how often they occurred.

    One pass: a message becomes a row per key it has and a row that stands for the message, folded
    by partial aggregation in the same task. A field is missing in the messages that do not have it,
    so only present keys need rows. Text fields take any value; only the others can be of a wrong type.
    """
    text = F.col("value").cast("string")
    checked = [T.StructField(f.name, f.dataType, True) for f in schema.fields if f.dataType != T.StringType()]
    typed = F.from_json(text, T.StructType(checked)) if checked else F.lit(None)
    both = F.struct(F.from_json(text, "map<string,string>").alias("found"), typed.alias("typed"))
    # As a generated row the decoded message is computed once, however often it is used below.
    decoded = raw.select(F.inline(F.filter(F.array(both), lambda m: m["found"].isNotNull())))

    def line(field: Column, present: Column | int = 0, nulls: Column | int = 0, bad: Column | int = 0) -> Column:
        counts = {"present": present, "nulls": nulls, "bad_type": bad}
        whole = [(F.lit(c) if isinstance(c, int) else c).cast("long").alias(n) for n, c in counts.items()]
        return F.struct(field.cast("string").alias("field"), *whole)

    keys = F.transform(F.map_entries("found"), lambda e: line(e["key"], 1, e["value"].isNull()))
    wrong = [
        line(F.lit(f.name), bad=F.col("found")[f.name].isNotNull() & F.col("typed")[f.name].isNull()) for f in checked
    ]
    lines = F.concat(keys, F.array(line(F.lit(None), 1), *wrong))
    per_key = decoded.select(F.inline(lines)).groupBy("field").agg(
        *[F.sum(c).alias(c) for c in ("present", "nulls", "bad_type")]
    )

    # A row per key is left. The messages' row (no field) gives every contract field its total.
    names = [f.name for f in schema.fields]
    none, present = F.lit(0).cast("long"), F.col("present")

    def result(field: Column, missing: Column, nulls: Column, bad: Column, unknown: Column) -> Column:
        columns = {"field": field, "missing": missing, "nulls": nulls, "bad_type": bad, "unknown": unknown}
        return F.struct(*[c.alias(n) for n, c in columns.items()])

    rows = (
        F.when(F.col("field").isNull(), F.array(*[result(F.lit(n), present, none, none, none) for n in names]))
        .when(F.col("field").isin(names), F.array(result(F.col("field"), -present, F.col("nulls"), F.col("bad_type"), none)))
        .otherwise(F.array(result(F.col("field"), none, none, none, present)))
    )
    return per_key.select(F.inline(rows)).groupBy("field").agg(
        *[F.sum(c).alias(c) for c in ("missing", "nulls", "bad_type", "unknown")]
    )
