"""Conformed dimension views and the join that attaches them.

No view is hinted ``broadcast``: Spark broadcasts a dimension while its size
estimate (or, at run time, its measured size) is under the session's broadcast
threshold and shuffles it beyond that.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, functions as F


def _renamed(df: DataFrame, key: str, **names: str) -> DataFrame:
    """Key plus ``new=old`` columns."""
    return df.select(key, *[F.col(old).alias(new) for new, old in names.items()])


def city(tables: Mapping[str, DataFrame]) -> DataFrame:
    return _renamed(tables["dim_ciudad"], "ciudad_id",
                    ciudad_nombre="ciudad", ciudad_departamento="departamento", ciudad_region="region")


def city_as(tables: Mapping[str, DataFrame], role: str) -> DataFrame:
    """The city dimension playing a role (origin, destination)."""
    return _renamed(city(tables).withColumnRenamed("ciudad_id", f"ciudad_{role}_id"), f"ciudad_{role}_id", **{
        f"ciudad_{role}_nombre": "ciudad_nombre",
        f"departamento_{role}": "ciudad_departamento",
        f"region_{role}": "ciudad_region",
    })


def store(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Store flattened with its city."""
    placed = tables["dim_tienda"].join(city(tables), "ciudad_id", "left")
    return _renamed(placed, "tienda_id",
                    tienda_nombre="nombre_tienda", tienda_tipo_sede="tipo_sede", tienda_estado_sede="estado_sede",
                    tienda_ciudad_nombre="ciudad_nombre", tienda_departamento="ciudad_departamento",
                    tienda_region="ciudad_region")


def channel(tables: Mapping[str, DataFrame]) -> DataFrame:
    return _renamed(tables["dim_canal_venta"], "canal_id",
                    canal_nombre="canal", canal_tipo="tipo_canal", canal_descripcion="descripcion")


def product(tables: Mapping[str, DataFrame]) -> DataFrame:
    return _renamed(tables["dim_producto"], "producto_id", sku="sku",
                    producto_nombre="nombre_producto", producto_marca="marca", producto_especie="especie",
                    producto_unidad_medida="unidad_medida", producto_nivel_rotacion="nivel_rotacion")


def category(tables: Mapping[str, DataFrame]) -> DataFrame:
    return _renamed(tables["dim_categoria_producto"], "categoria_id",
                    categoria_producto="categoria", categoria_familia="familia",
                    categoria_especie_principal="especie_principal", categoria_descripcion="descripcion")


def return_reason(tables: Mapping[str, DataFrame]) -> DataFrame:
    return tables["dim_motivo_devolucion"].select(
        "motivo_devolucion_id", "motivo_devolucion", "responsable_principal", "severidad")


def campaign(tables: Mapping[str, DataFrame]) -> DataFrame:
    return _renamed(tables["dim_campana_marketing"], "campana_id", campana_nombre="campana",
                    tipo_campana="tipo_campana", categorias_objetivo="categorias_objetivo",
                    canales_objetivo="canales_objetivo", activa="activa")


def supplier(tables: Mapping[str, DataFrame]) -> DataFrame:
    return _renamed(tables["dim_proveedor"], "proveedor_id", proveedor_nombre="proveedor",
                    tipo_proveedor="tipo_proveedor", especialidad="especialidad",
                    estado_proveedor="estado_proveedor", lead_time_promedio_dias="lead_time_promedio_dias",
                    calificacion_servicio="calificacion_servicio")


def carrier(tables: Mapping[str, DataFrame]) -> DataFrame:
    return _renamed(tables["dim_transportista"], "transportista_id", transportista_nombre="transportista",
                    tipo_transportista="tipo_transportista", cobertura="cobertura")


def negotiated_terms(tables: Mapping[str, DataFrame]) -> DataFrame:
    return tables["bridge_producto_proveedor"].select(
        "producto_id", "proveedor_id", "costo_negociado", "lead_time_dias")


def attach(df: DataFrame, *views: DataFrame) -> DataFrame:
    """Left-join dimension views on their first column; rows without a match keep NULLs."""
    for view in views:
        df = df.join(view, view.columns[0], "left")
    return df


def attach_product(df: DataFrame, tables: Mapping[str, DataFrame], before: Callable[[DataFrame], DataFrame], *after: DataFrame) -> DataFrame:
    """Attach what ``before`` attaches, the product, and the views ``after`` it; columns in that order.

    Products are the one large dimension, so they are joined first: a shuffle for that join carries no names of the others.
    """
    view = product(tables)
    key, *names = view.columns
    others = [c for c in before(df).columns if c != key]
    return attach(before(attach(df, view)).select(key, *others, *names), *after)


def attach_store(df: DataFrame, tables: Mapping[str, DataFrame]) -> DataFrame:
    """Store and store city, joined one after the other.

    The flattened view is right but costly here: Spark estimates a join as the
    product of its sides, so it would shuffle a product by its few store ids to
    meet a view that is in fact tiny.  Each table alone has a known size.
    """
    stores = _renamed(tables["dim_tienda"], "tienda_id", tienda_nombre="nombre_tienda",
                      tienda_tipo_sede="tipo_sede", tienda_estado_sede="estado_sede", _sede="ciudad_id")
    places = _renamed(city(tables).withColumnRenamed("ciudad_id", "_sede"), "_sede",
                      tienda_ciudad_nombre="ciudad_nombre", tienda_departamento="ciudad_departamento",
                      tienda_region="ciudad_region")
    return attach(df, stores, places).drop("_sede")
