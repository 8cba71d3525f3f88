"""Declared tables: columns, keys and rules of every layer.

Fixed values: table and column names, types, key columns, domains and ranges are
the data model itself and must stay as they are for existing queries to run.
Identifiers are BIGINT, since INT runs out at warehouse scale, and amounts summed
over the lines of an order are DECIMAL(18,2), since one order may hold very many.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from dataclasses import dataclass, field, replace
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .operators.quality import (
    ForeignKey, RowRule, Unique, check, in_domain, in_range, max_length, not_before, not_null, rule_reports,
)


@dataclass(frozen=True)
class Table:
    """One declared table.

    ``columns`` is a DDL string; a trailing ``?`` on a name marks it nullable.
    ``lengths`` holds the maximum text lengths, ``positive`` columns must be > 0,
    ``not_negative`` >= 0, ``percent`` within 0..100.
    """

    columns: str
    key: tuple[str, ...]
    unique: tuple[tuple[str, ...], ...] = ()
    parents: Mapping[str, str] = field(default_factory=dict)
    domains: Mapping[str, tuple[str, ...]] = field(default_factory=dict)
    positive: tuple[str, ...] = ()
    not_negative: tuple[str, ...] = ()
    percent: tuple[str, ...] = ()
    date_order: tuple[tuple[str, str], ...] = ()
    strict_date_order: tuple[tuple[str, str], ...] = ()
    lengths: Mapping[str, int] = field(default_factory=dict)

    def _fields(self) -> list[tuple[str, str, bool]]:
        fields, depth, item = [], 0, ""
        for ch in self.columns + ",":
            depth += (ch == "(") - (ch == ")")
            if ch == "," and depth == 0:
                name, kind = item.split()
                fields.append((name.rstrip("?"), kind, name.endswith("?")))
                item = ""
            else:
                item += ch
        return fields

    @property
    def schema(self) -> T.StructType:
        return T.StructType.fromDDL(
            ", ".join(f"{n} {k}" + ("" if nullable else " NOT NULL") for n, k, nullable in self._fields())
        )

    @property
    def names(self) -> list[str]:
        return [n for n, _, _ in self._fields()]

    def rules(self, parents: Mapping[str, DataFrame] | None = None) -> list[RowRule | Unique | ForeignKey]:
        """All declared rules; foreign keys only for the parents given."""
        rules: list = [not_null(n) for n, _, nullable in self._fields() if not nullable]
        rules += [in_domain(c, values) for c, values in self.domains.items()]
        rules += [in_range(c, 0, open_low=True) for c in self.positive]
        rules += [in_range(c, 0) for c in self.not_negative]
        rules += [in_range(c, 0, 100) for c in self.percent]
        rules += [not_before(later, earlier) for later, earlier in self.date_order]
        rules += [not_before(later, earlier, strict=True) for later, earlier in self.strict_date_order]
        rules += [max_length(c, n) for c, n in self.lengths.items()]
        rules += [Unique(u) for u in (self.key, *self.unique) if u]
        for column, parent in self.parents.items():
            if parents and parent in parents:
                rules.append(ForeignKey([column], parents[parent], [OLTP[parent].key[0] if parent in OLTP else column]))
        return rules


#: The longest text of each column, by table. Codes made from identifiers (tax numbers, port codes) are
#: longer than in the narrower model, since identifiers are BIGINT here.
LENGTHS = {
    "fincas": {"nombre_finca": 100, "municipio": 100, "provincia": 100, "zona_agricola": 100, "tipo_suelo": 100, "sistema_riego": 100},
    "parcelas": {"nombre_parcela": 100, "cultivo_actual": 100},
    "campanias": {"nombre_campania": 100, "temporada": 50, "observaciones_climaticas": 255},
    "cultivos": {"nombre_producto": 100, "familia_producto": 100, "variedad": 100},
    "lotes_origen": {"codigo_lote": 30, "estado": 20},
    "lotes": {"codigo_lote": 30, "producto": 100},
    "controles_calidad": {"inspector": 120},
    "calibres": {"calibre": 10},
    "certificados": {"tipo_certificado": 50, "entidad_certificadora": 100, "numero_certificado": 50},
    "incidencias_calidad": {"tipo_incidencia": 50, "descripcion": 255, "accion_correctiva": 255},
    "clientes": {"nombre_cliente": 150, "cif": 30, "tipo_cliente": 50, "canal": 50, "segmento": 50, "pais": 100, "ciudad": 100,
                 "direccion": 150, "codigo_postal": 15, "telefono": 30, "email": 150},
    "contratos": {"condiciones_pago": 100},
    "pedidos": {"estado": 30, "observaciones": 255},
    "detalle_pedido": {"producto": 100, "variedad": 100},
    "tarifas": {"producto": 100, "variedad": 100, "calibre": 10},
    "transitarios": {"nombre_transitario": 150, "cif": 30, "pais": 100, "telefono": 30, "email": 150, "tipo_transporte": 30},
    "puertos": {"nombre_puerto": 120, "ciudad": 100, "pais": 100, "tipo": 30, "codigo_un_locode": 30},
    "rutas_logisticas": {"tipo_transporte": 30, "observaciones": 255},
    "envios": {"numero_contenedor": 30, "estado": 30},
    "aduanas": {"pais_aduana": 100},
    "incidencias_envio": {"tipo_incidencia": 50, "descripcion": 255, "responsable": 100},
    "facturas": {"divisa": 10, "estado": 20},
    "cobros": {"metodo_pago": 30, "banco": 100, "observaciones": 255},
    "tipos_cambio": {"divisa_origen": 10, "divisa_destino": 10},
    "dim_tiempo": {"dia_semana": 20},
    "dim_campania": {"nombre_campania": 100, "temporada": 50, "observaciones_climaticas": 255},
    "dim_cliente": {"nombre_cliente": 150, "tipo_cliente": 50, "canal": 50, "segmento": 50, "pais_cliente": 100, "ciudad_cliente": 100,
                    "email": 150, "telefono": 30},
    "dim_geografia": {"ciudad": 100, "provincia": 100, "region": 100, "pais": 100, "zona_comercial": 100, "continente": 100},
    "dim_finca": {"nombre_finca": 150, "parcela": 100, "municipio": 100, "provincia": 100, "zona_agricola": 100, "tipo_suelo": 100,
                  "sistema_riego": 100},
    "dim_producto": {"nombre_producto": 100, "variedad": 100, "familia_producto": 100, "tipo_envase": 100, "formato_comercial": 100},
    "dim_familia_producto": {"familia_producto": 100},
    "dim_calidad": {"categoria_comercial": 50, "calibre": 20, "tipo_certificado": 100, "estado_lote": 50},
    "dim_logistica": {"nombre_transitario": 150, "puerto_salida": 100, "puerto_llegada": 100, "tipo_transporte": 50, "ruta_logistica": 150},
}


def _sized(tables: Mapping[str, Table]) -> dict[str, Table]:
    return {name: replace(table, lengths={c: n for c, n in LENGTHS.get(name, {}).items() if c in table.names})
            for name, table in tables.items()}


PRODUCTION = {
    "fincas": Table(
        "finca_id BIGINT, nombre_finca STRING, superficie_total_hectareas DECIMAL(10,2), municipio STRING, "
        "provincia STRING, zona_agricola STRING, tipo_suelo STRING, sistema_riego STRING",
        key=("finca_id",), positive=("superficie_total_hectareas",)),
    "parcelas": Table(
        "parcela_id BIGINT, finca_id BIGINT, nombre_parcela STRING, superficie_hectareas DECIMAL(8,2), "
        "cultivo_actual STRING, fecha_ultima_rotacion DATE",
        key=("parcela_id",), parents={"finca_id": "fincas"}, positive=("superficie_hectareas",)),
    "campanias": Table(
        "campania_id BIGINT, nombre_campania STRING, fecha_inicio DATE, fecha_fin DATE, temporada STRING, "
        "anio_agricola INT, observaciones_climaticas? STRING",
        key=("campania_id",), strict_date_order=(("fecha_fin", "fecha_inicio"),)),
    "cultivos": Table(
        "cultivo_id BIGINT, nombre_producto STRING, familia_producto STRING, variedad STRING, ciclo_dias INT, "
        "riego_necesario_litros_hectarea DECIMAL(12,2)",
        key=("cultivo_id",), positive=("ciclo_dias", "riego_necesario_litros_hectarea")),
    "cosechas": Table(
        "cosecha_id BIGINT, parcela_id BIGINT, cultivo_id BIGINT, campania_id BIGINT, fecha_cosecha DATE, "
        "kilos_cosechados DECIMAL(10,2), rendimiento_kg_hectarea DECIMAL(12,2), coste_produccion DECIMAL(12,2), "
        "merma_campo_porcentaje DECIMAL(5,2), numero_recolecciones INT",
        key=("cosecha_id",), parents={"parcela_id": "parcelas", "cultivo_id": "cultivos", "campania_id": "campanias"},
        positive=("kilos_cosechados", "numero_recolecciones"),
        not_negative=("rendimiento_kg_hectarea", "coste_produccion"), percent=("merma_campo_porcentaje",)),
    "lotes_origen": Table(
        "lote_id BIGINT, cosecha_id BIGINT, codigo_lote STRING, kilos_lote DECIMAL(10,2), fecha_creacion_lote DATE, "
        "estado STRING",
        key=("lote_id",), unique=(("codigo_lote",),), parents={"cosecha_id": "cosechas"}, positive=("kilos_lote",),
        domains={"estado": ("en_campo", "en_almacen", "enviado")}),
}

SIZES = ("S", "M", "L", "XL")
CERTIFICATES = ("GlobalGAP", "ECO", "ISO22000", "GRASP")

QUALITY = {
    "lotes": Table(
        "lote_id BIGINT, codigo_lote STRING, producto STRING, kilos_totales DECIMAL(10,2), fecha_entrada_almacen DATE",
        key=("lote_id",), unique=(("codigo_lote",),), parents={"lote_id": "lotes_origen"}, positive=("kilos_totales",)),
    "controles_calidad": Table(
        "control_id BIGINT, lote_id BIGINT, fecha_control DATE, inspector STRING, kilos_inspeccionados DECIMAL(10,2), "
        "kilos_rechazados DECIMAL(10,2), porcentaje_merma DECIMAL(5,2), porcentaje_primera_categoria DECIMAL(5,2), "
        "porcentaje_segunda_categoria DECIMAL(5,2), puntuacion_calidad DECIMAL(4,2)",
        key=("control_id",), parents={"lote_id": "lotes"}, positive=("kilos_inspeccionados",),
        not_negative=("kilos_rechazados",),
        percent=("porcentaje_merma", "porcentaje_primera_categoria", "porcentaje_segunda_categoria")),
    "calibres": Table(
        "calibre_id BIGINT, lote_id BIGINT, calibre STRING, kilos_calibre DECIMAL(10,2), "
        "porcentaje_sobre_total DECIMAL(5,2)",
        key=("calibre_id",), parents={"lote_id": "lotes"}, domains={"calibre": SIZES},
        not_negative=("kilos_calibre",), percent=("porcentaje_sobre_total",)),
    "certificados": Table(
        "certificado_id BIGINT, lote_id BIGINT, tipo_certificado STRING, fecha_emision DATE, fecha_caducidad DATE, "
        "entidad_certificadora STRING, numero_certificado STRING",
        key=("certificado_id",), unique=(("numero_certificado",),), parents={"lote_id": "lotes"},
        domains={"tipo_certificado": CERTIFICATES}, strict_date_order=(("fecha_caducidad", "fecha_emision"),)),
    "incidencias_calidad": Table(
        "incidencia_id BIGINT, lote_id BIGINT, fecha_incidencia DATE, tipo_incidencia STRING, descripcion STRING, "
        "kilos_afectados DECIMAL(10,2), accion_correctiva STRING",
        key=("incidencia_id",), parents={"lote_id": "lotes"}, not_negative=("kilos_afectados",),
        domains={"tipo_incidencia": ("plagas", "defectos", "contaminacion", "rechazo_cliente")}),
}

SALES = {
    "clientes": Table(
        "cliente_id BIGINT, nombre_cliente STRING, cif STRING, tipo_cliente STRING, canal STRING, segmento STRING, "
        "pais STRING, ciudad STRING, direccion STRING, codigo_postal STRING, telefono STRING, email STRING, "
        "fecha_alta DATE",
        key=("cliente_id",), unique=(("cif",),),
        domains={"tipo_cliente": ("mayorista", "distribuidor", "minorista", "retail"),
                 "canal": ("directo", "intermediario", "plataforma"),
                 "segmento": ("premium", "estandar", "ocasional")}),
    "contratos": Table(
        "contrato_id BIGINT, cliente_id BIGINT, fecha_inicio DATE, fecha_fin DATE, condiciones_pago STRING, "
        "descuento_general_porcentaje DECIMAL(5,2), volumen_minimo_kg DECIMAL(10,2), precio_base_kg DECIMAL(10,2)",
        key=("contrato_id",), parents={"cliente_id": "clientes"}, percent=("descuento_general_porcentaje",),
        not_negative=("volumen_minimo_kg",), positive=("precio_base_kg",), date_order=(("fecha_fin", "fecha_inicio"),)),
    "pedidos": Table(
        "pedido_id BIGINT, cliente_id BIGINT, contrato_id? BIGINT, fecha_pedido DATE, fecha_entrega_solicitada DATE, "
        "estado STRING, observaciones? STRING",
        key=("pedido_id",), parents={"cliente_id": "clientes", "contrato_id": "contratos"},
        domains={"estado": ("pendiente", "confirmado", "enviado", "entregado", "cancelado")},
        date_order=(("fecha_entrega_solicitada", "fecha_pedido"),)),
    "detalle_pedido": Table(
        "detalle_id BIGINT, pedido_id BIGINT, lote_id BIGINT, producto STRING, variedad STRING, "
        "kilos_solicitados DECIMAL(10,2), cajas_solicitadas INT, precio_unitario_kg DECIMAL(10,2), "
        "descuento_porcentaje DECIMAL(5,2), importe_bruto DECIMAL(12,2), importe_neto DECIMAL(12,2)",
        key=("detalle_id",), parents={"pedido_id": "pedidos", "lote_id": "lotes"},
        positive=("kilos_solicitados", "cajas_solicitadas", "precio_unitario_kg"), percent=("descuento_porcentaje",)),
    "tarifas": Table(
        "tarifa_id BIGINT, producto STRING, variedad STRING, calibre STRING, precio_base_kg DECIMAL(10,2), "
        "fecha_vigencia_inicio DATE, fecha_vigencia_fin DATE",
        key=("tarifa_id",), domains={"calibre": SIZES}, positive=("precio_base_kg",),
        date_order=(("fecha_vigencia_fin", "fecha_vigencia_inicio"),)),
}

TRANSPORT = ("maritimo", "terrestre", "aereo", "multimodal")

LOGISTICS = {
    "transitarios": Table(
        "transitario_id BIGINT, nombre_transitario STRING, cif STRING, pais STRING, telefono STRING, email STRING, "
        "tipo_transporte STRING, tarifa_base_kg DECIMAL(10,2)",
        key=("transitario_id",), unique=(("cif",),), domains={"tipo_transporte": TRANSPORT},
        positive=("tarifa_base_kg",)),
    "puertos": Table(
        "puerto_id BIGINT, nombre_puerto STRING, ciudad STRING, pais STRING, tipo STRING, codigo_un_locode STRING",
        key=("puerto_id",), unique=(("codigo_un_locode",),), domains={"tipo": ("maritimo", "aereo", "terrestre")}),
    "rutas_logisticas": Table(
        "ruta_id BIGINT, transitario_id BIGINT, puerto_salida_id BIGINT, puerto_llegada_id BIGINT, "
        "tipo_transporte STRING, duracion_estimada_dias INT, coste_base_kg DECIMAL(10,2), observaciones? STRING",
        key=("ruta_id",), domains={"tipo_transporte": TRANSPORT},
        parents={"transitario_id": "transitarios", "puerto_salida_id": "puertos", "puerto_llegada_id": "puertos"},
        positive=("duracion_estimada_dias", "coste_base_kg")),
    "envios": Table(
        "envio_id BIGINT, pedido_id BIGINT, ruta_id BIGINT, transitario_id BIGINT, fecha_envio DATE, "
        "fecha_entrega_estimada DATE, fecha_entrega_real DATE, kilos_totales DECIMAL(18,2), numero_contenedor STRING, "
        "coste_envio_total DECIMAL(18,2), coste_por_kg DECIMAL(10,4), estado STRING",
        key=("envio_id",), positive=("kilos_totales",), not_negative=("coste_envio_total", "coste_por_kg"),
        parents={"pedido_id": "pedidos", "ruta_id": "rutas_logisticas", "transitario_id": "transitarios"},
        domains={"estado": ("preparado", "en_transito", "aduana", "entregado", "incidencia")},
        date_order=(("fecha_entrega_estimada", "fecha_envio"), ("fecha_entrega_real", "fecha_envio"))),
    "aduanas": Table(
        "aduana_id BIGINT, envio_id BIGINT, pais_aduana STRING, fecha_entrada_aduana DATE, fecha_salida_aduana DATE, "
        "coste_aranceles DECIMAL(12,2), documentacion_completa BOOLEAN",
        key=("aduana_id",), parents={"envio_id": "envios"}, not_negative=("coste_aranceles",),
        date_order=(("fecha_salida_aduana", "fecha_entrada_aduana"),)),
    "incidencias_envio": Table(
        "incidencia_envio_id BIGINT, envio_id BIGINT, fecha_incidencia DATE, tipo_incidencia STRING, "
        "descripcion STRING, coste_adicional DECIMAL(10,2), responsable STRING",
        key=("incidencia_envio_id",), parents={"envio_id": "envios"}, not_negative=("coste_adicional",),
        domains={"tipo_incidencia": ("retraso", "merma", "rechazo_aduana", "danos_transporte")}),
}

FINANCE = {
    "facturas": Table(
        "factura_id BIGINT, pedido_id BIGINT, fecha_emision DATE, fecha_vencimiento DATE, importe_bruto DECIMAL(18,2), "
        "descuento DECIMAL(18,2), impuestos DECIMAL(18,2), importe_total DECIMAL(18,2), divisa STRING, estado STRING",
        key=("factura_id",), unique=(("pedido_id",),), parents={"pedido_id": "pedidos"},
        domains={"estado": ("pendiente", "pagada", "vencida", "anulada")},
        date_order=(("fecha_vencimiento", "fecha_emision"),)),
    "cobros": Table(
        "cobro_id BIGINT, factura_id BIGINT, fecha_cobro DATE, importe_cobrado DECIMAL(18,2), metodo_pago STRING, "
        "banco STRING, observaciones? STRING",
        key=("cobro_id",), parents={"factura_id": "facturas"}, positive=("importe_cobrado",),
        domains={"metodo_pago": ("transferencia", "credito", "contado")}),
    "costes_lote": Table(
        "coste_lote_id BIGINT, lote_id BIGINT, coste_semillas DECIMAL(12,2), coste_agua DECIMAL(12,2), "
        "coste_fertilizantes DECIMAL(12,2), coste_mano_obra DECIMAL(12,2), coste_maquinaria DECIMAL(12,2), "
        "coste_total_produccion DECIMAL(12,2), coste_por_kg DECIMAL(10,4)",
        key=("coste_lote_id",), unique=(("lote_id",),), parents={"lote_id": "lotes_origen"},
        not_negative=("coste_semillas", "coste_agua", "coste_fertilizantes", "coste_mano_obra", "coste_maquinaria",
                      "coste_total_produccion", "coste_por_kg")),
    "costes_logisticos": Table(
        "coste_logistico_id BIGINT, envio_id BIGINT, coste_transporte DECIMAL(18,2), coste_aduana DECIMAL(12,2), "
        "coste_almacenaje DECIMAL(12,2), coste_seguro DECIMAL(12,2), coste_total_logistica DECIMAL(18,2), "
        "coste_por_kg DECIMAL(10,4)",
        key=("coste_logistico_id",), unique=(("envio_id",),), parents={"envio_id": "envios"},
        not_negative=("coste_transporte", "coste_aduana", "coste_almacenaje", "coste_seguro", "coste_total_logistica",
                      "coste_por_kg")),
    "tipos_cambio": Table(
        "tipo_cambio_id BIGINT, divisa_origen STRING, divisa_destino STRING, fecha DATE, tasa_cambio DECIMAL(10,4)",
        key=("tipo_cambio_id",), positive=("tasa_cambio",)),
}

PRODUCTION, QUALITY, SALES, LOGISTICS, FINANCE = map(_sized, (PRODUCTION, QUALITY, SALES, LOGISTICS, FINANCE))
OLTP = {**PRODUCTION, **QUALITY, **SALES, **LOGISTICS, **FINANCE}

STAR = {
    "dim_tiempo": Table(
        "tiempo_sk BIGINT, fecha DATE, dia INT, mes INT, trimestre INT, anio INT, semana? INT, dia_semana? STRING, "
        "es_festivo? BOOLEAN",
        key=("tiempo_sk",), unique=(("fecha",),)),
    "dim_campania": Table(
        "campania_sk BIGINT, campania_id BIGINT, nombre_campania STRING, fecha_inicio? DATE, fecha_fin? DATE, "
        "temporada? STRING, anio_agricola? INT, observaciones_climaticas? STRING",
        key=("campania_sk",)),
    "dim_cliente": Table(
        "cliente_sk BIGINT, cliente_id BIGINT, nombre_cliente STRING, tipo_cliente? STRING, canal? STRING, "
        "segmento? STRING, pais_cliente? STRING, ciudad_cliente? STRING, email? STRING, telefono? STRING",
        key=("cliente_sk",)),
    "dim_geografia": Table(
        "geografia_sk BIGINT, ciudad? STRING, provincia? STRING, region? STRING, pais? STRING, "
        "zona_comercial? STRING, continente? STRING",
        key=("geografia_sk",)),
    "dim_finca": Table(
        "finca_sk BIGINT, finca_id BIGINT, nombre_finca STRING, parcela? STRING, superficie_hectareas? DECIMAL(10,2), "
        "municipio? STRING, provincia? STRING, zona_agricola? STRING, tipo_suelo? STRING, sistema_riego? STRING",
        key=("finca_sk",)),
    "dim_producto": Table(
        "producto_sk BIGINT, cultivo_id BIGINT, nombre_producto STRING, variedad STRING, familia_producto STRING, "
        "tipo_envase? STRING, formato_comercial? STRING, peso_unidad? DECIMAL(10,2)",
        key=("producto_sk",)),
    "dim_calidad": Table(
        "calidad_sk BIGINT, lote_id BIGINT, categoria_comercial? STRING, calibre? STRING, tipo_certificado? STRING, "
        "estado_lote? STRING, tiene_certificacion_eco? BOOLEAN, tiene_certificacion_global_gap? BOOLEAN",
        key=("calidad_sk",)),
    "dim_logistica": Table(
        "logistica_sk BIGINT, ruta_id BIGINT, nombre_transitario STRING, puerto_salida STRING, puerto_llegada STRING, "
        "tipo_transporte STRING, ruta_logistica? STRING, duracion_estimada_dias? INT",
        key=("logistica_sk",)),
    "fact_exportaciones": Table(
        "detalle_id BIGINT, pedido_id BIGINT, tiempo_sk BIGINT, producto_sk BIGINT, cliente_sk BIGINT, geografia_sk BIGINT, finca_sk BIGINT, "
        "calidad_sk BIGINT, logistica_sk BIGINT, campania_sk BIGINT, kilos_vendidos DECIMAL(12,2), cajas_vendidas INT, "
        "importe_bruto DECIMAL(12,2), descuento DECIMAL(12,2), importe_neto DECIMAL(12,2), "
        "coste_producto DECIMAL(12,2), coste_logistico DECIMAL(12,2), coste_total DECIMAL(12,2), margen DECIMAL(12,2), "
        "precio_medio_kg DECIMAL(12,4), tiempo_entrega_dias INT",
        key=(),  # one row per order line; its id is kept so that loads can be repeated, but given lines may share one
        parents={"tiempo_sk": "dim_tiempo", "producto_sk": "dim_producto", "cliente_sk": "dim_cliente",
                 "geografia_sk": "dim_geografia", "finca_sk": "dim_finca", "calidad_sk": "dim_calidad",
                 "logistica_sk": "dim_logistica", "campania_sk": "dim_campania"}),
}

#: The snowflake model is the star model with the product family split out.
SNOW = {
    **STAR,
    "dim_familia_producto": Table(
        "familia_sk BIGINT, familia_producto STRING", key=("familia_sk",), unique=(("familia_producto",),)),
    "dim_producto": Table(
        STAR["dim_producto"].columns.replace("familia_producto STRING", "familia_sk BIGINT"),
        key=("producto_sk",), parents={"familia_sk": "dim_familia_producto"}),
}
STAR, SNOW = _sized(STAR), _sized(SNOW)

WEATHER = {
    "estaciones_meteorologicas": Table(
        "estacion_id BIGINT, nombre_estacion STRING, ciudad STRING, latitud DECIMAL(9,6), longitud DECIMAL(9,6), "
        "altitud_metros INT, activa BOOLEAN, fecha_instalacion DATE",
        key=("estacion_id",)),
    "observaciones_diarias": Table(
        "observacion_id BIGINT, fecha DATE, ciudad? STRING, estacion_id? BIGINT, temp_max? DECIMAL(5,1), "
        "temp_min? DECIMAL(5,1), temp_media? DECIMAL(5,1), precipitacion_mm? DECIMAL(6,1), humedad_pct? INT, "
        "velocidad_viento_kmh? DECIMAL(5,1), condicion_climatica? STRING",
        key=("observacion_id",)),
    "dim_clima": Table(
        "fecha DATE, ciudad? STRING, anio INT, mes INT, dia_del_anio INT, temp_max? DECIMAL(5,1), "
        "temp_min? DECIMAL(5,1), temp_media? DECIMAL(5,1), precipitacion_mm? DECIMAL(6,1), humedad_pct? INT, "
        "velocidad_viento_kmh? DECIMAL(5,1), condicion_climatica? STRING, es_dia_lluvia BOOLEAN, "
        "categoria_temperatura STRING",
        key=("fecha", "ciudad")),
}


def cross_column_rules(table: str) -> list[RowRule]:
    """Arithmetic a row must satisfy."""
    net = F.round(F.col("importe_bruto") * (1 - F.col("descuento_porcentaje") / F.lit(100)), 2)
    total = F.round(F.col("importe_bruto") - F.col("descuento") + F.col("impuestos"), 2)
    return {
        "detalle_pedido": [check("importe_neto", F.col("importe_neto") == net, F.col("importe_neto"))],
        "facturas": [check("importe_total", F.col("importe_total") == total, F.col("importe_total"))],
        "controles_calidad": [in_range("puntuacion_calidad", 0, 10)],
    }.get(table, [])


def payments_before_invoice(payments: DataFrame, invoices: DataFrame) -> DataFrame:
    """Payments dated before their invoice was issued (a rule across two tables)."""
    joined = payments.join(invoices.select("factura_id", "fecha_emision"), "factura_id")
    return joined.filter(F.col("fecha_cobro") < F.col("fecha_emision")).select(
        F.lit("order:fecha_emision<=fecha_cobro").alias("rule"),
        F.col("cobro_id").cast("string").alias("key"),
        F.col("fecha_cobro").cast("string").alias("value"),
    )


def layer_reports(tables: Mapping[str, DataFrame], declared: Mapping[str, Table] = OLTP) -> Iterator[DataFrame]:
    """Reports of every declared rule over the given tables, as (tabla, rule, key, value); each is a job of its own size."""
    for name, df in tables.items():
        table = declared[name]
        for report in rule_reports(df, table.key or ("detalle_id",), table.rules(tables) + cross_column_rules(name)):
            yield report.select(F.lit(name).alias("tabla"), "rule", "key", "value")
    if "cobros" in tables and "facturas" in tables:
        late = payments_before_invoice(tables["cobros"], tables["facturas"])
        yield late.select(F.lit("cobros").alias("tabla"), "rule", "key", "value")


def validate_layer(tables: Mapping[str, DataFrame], declared: Mapping[str, Table] = OLTP) -> DataFrame:
    """Violations of every declared rule over the given tables, as (tabla, rule, key, value)."""
    return reduce(DataFrame.unionByName, layer_reports(tables, declared))
