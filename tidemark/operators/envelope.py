"""The lines published: bare rows for the lake, enveloped rows for the share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.checkpoint import Checkpoint
from tidemark.contract import UPDATED_AT, Contract
from tidemark.functions.canonical import canonical_row, canonical_text, encoded, iso_utc
from tidemark.functions.digest import schema_fingerprint

OP_UPSERT = "upsert"

MARK_TYPE = T.StructType([T.StructField("last_pk", T.LongType()), T.StructField("updated_at", T.StringType())])
CHECKPOINT_TYPE = T.MapType(T.StringType(), MARK_TYPE)


def checkpoint_column(checkpoint: Checkpoint) -> Column:
    """The checkpoint as ``map<table, struct<last_pk, updated_at>>``, keys in order."""
    entries: list[Column] = []
    for table, mark in checkpoint.as_dict().items():
        entries += [
            F.lit(table),
            F.struct(
                F.lit(mark["last_pk"]).cast("bigint").alias("last_pk"), F.lit(mark["updated_at"]).alias("updated_at")
            ),
        ]
    return F.create_map(*entries).cast(CHECKPOINT_TYPE)


def share_schema(contract: Contract) -> T.StructType:
    return T.StructType(
        [
            T.StructField("table", T.StringType()),
            T.StructField("op", T.StringType()),
            T.StructField(contract.key, T.LongType()),
            T.StructField(UPDATED_AT, T.StringType()),
            T.StructField("run_id", T.StringType()),
            T.StructField("schema_fingerprint", T.StringType()),
            T.StructField("checkpoint_after", CHECKPOINT_TYPE),
            T.StructField("record", contract.schema),
        ]
    )


def share_fields(contract: Contract, run_id: Column, after: Checkpoint) -> dict[str, Column]:
    """The members of a share record; of the table's columns only its key is lifted to the top."""
    return {
        "table": F.lit(contract.name),
        "op": F.lit(OP_UPSERT),
        contract.key: F.col(contract.key).cast("bigint"),
        UPDATED_AT: encoded(F.col(UPDATED_AT), T.TimestampType()),
        "run_id": run_id,
        "schema_fingerprint": F.lit(schema_fingerprint(contract)),
        "checkpoint_after": checkpoint_column(after),
        "record": F.struct(*contract.column_names),
    }


def share_records(rows: DataFrame, contract: Contract, run_id: str, after: Checkpoint) -> DataFrame:
    return rows.select(*[c.alias(n) for n, c in share_fields(contract, F.lit(run_id), after).items()])


def lake_line(contract: Contract) -> Column:
    return canonical_row(contract.schema)


def envelope(contract: Contract, run_id: str, after: Checkpoint) -> tuple[Column, Column]:
    """What comes before and after the lake line in a share line.

    A canonical object is its members' canonical texts in order of their names. All but three
    members are the same for every row, and ``record`` is the lake line itself, so a share line
    costs little more than the lake line it surrounds.
    """
    constant = {
        "checkpoint_after": after.as_dict(),
        "op": OP_UPSERT,
        "run_id": run_id,
        "schema_fingerprint": schema_fingerprint(contract),
        "table": contract.name,
    }
    members = {name: F.lit(canonical_text(value)) for name, value in constant.items()}
    members[contract.key] = F.col(contract.key).cast("string")
    members[UPDATED_AT] = F.concat(F.lit('"'), iso_utc(F.col(UPDATED_AT)), F.lit('"'))

    def joined(names: list[str], lead: str, between: str) -> list[Column]:
        texts: list[Column] = []
        for i, name in enumerate(names):
            texts += [F.lit((between if i else lead) + canonical_text(name) + ":"), members[name]]
        return texts

    head = joined(sorted(n for n in members if n < "record"), "{", ",")
    tail = joined(sorted(n for n in members if n > "record"), ",", ",")
    return F.concat(*head, F.lit(',"record":')), F.concat(*tail, F.lit("}"))


def share_line(contract: Contract, run_id: str, after: Checkpoint) -> Column:
    head, tail = envelope(contract, run_id, after)
    return F.concat(head, lake_line(contract), tail)
