"""Customer cleaning: names, e-mails, type names; error log, staging and dimension loads."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import map_values, title_case
from ..operators.reshape import add_constant, select_values
from ..operators.route import route
from ..operators.upsert import insert_if_absent, upsert

# Fixed values.
TYPE_NAMES = {"mayorista": "Mayorista", "distribuidor": "Distribuidor", "minorista": "Minorista", "retail": "Retail"}
BAD_EMAIL = "email inválido o nulo"
STAGING_NAMES = {"cliente_id": "clienteid", "nombre_cliente": "nombrecliente", "tipo_cliente": "tipocliente",
                 "canal": "canal", "segmento": "segmento", "pais": "paiscliente", "ciudad": "ciudadcliente",
                 "email": "email", "telefono": "telefono"}
ERROR_NAMES = {"cliente_id": "clienteid", "email": "email", "motivo": "motivo"}
DIM_NAMES = {"clienteid": "cliente_id", "nombrecliente": "nombre_cliente", "tipocliente": "tipo_cliente",
             "canal": "canal", "segmento": "segmento", "paiscliente": "pais_cliente",
             "ciudadcliente": "ciudad_cliente", "email": "email", "telefono": "telefono"}


def normalise(customers: DataFrame) -> DataFrame:
    return customers.withColumns({"nombre_cliente": title_case("nombre_cliente"), "email": F.lower(F.trim("email"))})


def valid_email() -> Column:
    return F.col("email").isNotNull() & F.col("email").contains("@")


def staging_rows(normalised: DataFrame) -> DataFrame:
    return select_values(normalised.withColumn("tipo_cliente", map_values("tipo_cliente", TYPE_NAMES)), STAGING_NAMES)


def error_rows(normalised: DataFrame) -> DataFrame:
    return select_values(add_constant(normalised, "motivo", BAD_EMAIL), ERROR_NAMES)


def split_by_email(customers: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(staging rows, error rows) of the customers with and without a usable e-mail."""
    good, bad = route(normalise(customers), valid_email())
    return staging_rows(good), error_rows(bad)


def load_errors(log: DataFrame, errors: DataFrame) -> DataFrame:
    """Error log: the first error of a customer stays."""
    return insert_if_absent(log, errors, ["clienteid"], ["email", "motivo"])


def load_staging(staging: DataFrame, clean: DataFrame) -> DataFrame:
    return upsert(staging, clean, ["clienteid"])


def load_dimension(dim: DataFrame, staging: DataFrame) -> DataFrame:
    """Customer dimension of either model: attributes updated, keys kept, new customers numbered."""
    return upsert(dim, select_values(staging, DIM_NAMES), ["cliente_id"], sk="cliente_sk")
