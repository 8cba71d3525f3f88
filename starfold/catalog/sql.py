"""Building blocks of the SQL equivalents.

They state the same results from the given tables in plain SQL, without the
intermediate tables the jobs go through. SQL's decimal division gives doubles, so
exact quotients are formed on integers, rounding half away from zero.
"""

from __future__ import annotations


def half_up_int(num: str, den: str, scale: int, digits: int = 2) -> str:
    """``num / den`` times ``10^scale``, rounded to an integer; both have at most ``digits`` decimals."""
    n = f"CAST(({num}) * {10**digits} AS HUGEINT)"
    d = f"CAST(({den}) * {10**digits} AS HUGEINT)"
    return f"(sign({n}) * ((2 * abs({n}) * {10**scale} + {d}) // (2 * {d})))"


def scaled(integer: str, scale: int, kind: str) -> str:
    """An integer divided by ``10^scale`` as decimal ``kind``."""
    unit = f"CAST(0.{'0' * (scale - 1)}1 AS DECIMAL({scale + 1},{scale}))"
    return f"CAST(CAST({integer} AS DECIMAL(18,0)) * {unit} AS {kind})"


def half_up(num: str, den: str, scale: int, kind: str, digits: int = 2) -> str:
    return scaled(half_up_int(num, den, scale, digits), scale, kind)


def mean6(integer: str, scale: int) -> str:
    """Mean, to six decimals, of values given as integers times ``10^scale``."""
    up, down = 10 ** max(0, 6 - scale), 10 ** max(0, scale - 6)
    n, d = f"(CAST(SUM({integer}) AS HUGEINT) * {up})", f"(COUNT({integer}) * {down})"
    return scaled(f"(sign({n}) * ((2 * abs({n}) + {d}) // (2 * {d})))", 6, "DECIMAL(18,6)")


def pick(values: list[str], index: str) -> str:
    """Element ``index mod n`` of a list of texts."""
    return f"list_extract([{', '.join(repr(v) for v in values)}], CAST(({index}) % {len(values)} + 1 AS INT))"


def stepped(base: str, index: str, modulus: int, step: str) -> str:
    return f"CAST({base} + (({index}) % {modulus}) * {step} AS DECIMAL(12,2))"


def quoted(values) -> str:
    return ", ".join(f"'{v}'" for v in values)


SOUTH = "'NATION_0','NATION_5','NATION_10','NATION_15','NATION_20'"
CENTRE = "'NATION_1','NATION_6','NATION_11','NATION_16','NATION_21'"

_LOT_TOTAL = " + ".join([
    stepped("40", "p_partkey + 1", 12, "3"), stepped("35", "p_partkey + 1", 10, "2.5"),
    stepped("30", "p_partkey + 1", 9, "2.8"), stepped("80", "p_partkey + 1", 15, "4"),
    stepped("45", "p_partkey + 1", 11, "2.2")])
_SHIP_FIXED = " + ".join([
    stepped("10", "pedido_id", 8, "2"), stepped("8", "pedido_id", 6, "1.5"), stepped("5", "pedido_id", 5, "1.2")])
_NET_KILOS = "CAST(ROUND(CAST(900 + p_size * 42 AS DECIMAL(10,2)) * (100 - CAST(1.50 + (p_partkey % 10) * 0.65 AS DECIMAL(5,2))) * 0.01, 2) AS DECIMAL(10,2))"

#: name -> query; each may use those before it.
VIEWS = {
    "clientes": f"""SELECT c_custkey + 1 AS cliente_id, c_name AS nombre_cliente,
        {pick(['mayorista', 'distribuidor', 'minorista', 'retail'], 'c_custkey')} AS tipo_cliente,
        {pick(['directo', 'intermediario', 'plataforma'], 'c_custkey')} AS canal, lower(c_mktsegment) AS segmento,
        n_name AS pais, n_name || '-' || CAST(c_custkey % 4 AS VARCHAR) AS ciudad,
        'cliente' || CAST(c_custkey AS VARCHAR) || '@example.com' AS email,
        '+34-600-' || lpad(CAST(c_custkey % 1000000 AS VARCHAR), 6, '0') AS telefono
        FROM customer JOIN nation ON c_nationkey = n_nationkey""",
    "pedidos": """SELECT o_orderkey + 1 AS pedido_id, o_custkey + 1 AS cliente_id, CAST(o_orderdate AS DATE) AS fecha_pedido,
        o_orderstatus FROM orders""",
    "detalle": """SELECT (l_orderkey + 1) * 100 + l_linenumber AS detalle_id, l_orderkey + 1 AS pedido_id, l_partkey + 1 AS lote_id, CAST(l_quantity AS DECIMAL(10,2)) AS kilos,
        CAST(ceil(l_quantity / 5) AS INT) AS cajas, CAST(l_extendedprice AS DECIMAL(12,2)) AS bruto,
        CAST(ROUND(CAST(l_extendedprice AS DECIMAL(12,2)) * (1 - CAST(l_discount AS DECIMAL(5,2))), 2) AS DECIMAL(12,2)) AS neto,
        CAST(CAST(l_discount AS DECIMAL(5,2)) * 100 AS DECIMAL(5,2)) AS descuento_pct FROM lineitem""",
    "rutas": f"""SELECT s_suppkey + 1 AS ruta_id, 'Transitario_' || lpad(CAST(s_suppkey + 1 AS VARCHAR), 12, '0') AS nombre_transitario,
        'Puerto NATION_' || CAST(s_nationkey AS VARCHAR) AS puerto_salida,
        'NATION_' || CAST((s_nationkey + s_suppkey * 7 + 3) % (SELECT COUNT(*) FROM nation) AS VARCHAR) AS pais_llegada,
        'Puerto NATION_' || CAST((s_nationkey + s_suppkey * 7 + 3) % (SELECT COUNT(*) FROM nation) AS VARCHAR) AS puerto_llegada,
        {pick(['maritimo', 'terrestre', 'aereo', 'multimodal'], 's_suppkey')} AS tipo_transporte,
        CAST(2 + s_suppkey % 7 AS INT) AS dias_estimados, CAST(0.24 + (s_suppkey % 6) * 0.05 AS DECIMAL(10,2)) AS coste_kg
        FROM supplier""",
    "totales": """SELECT pedido_id, CAST(SUM(kilos) AS DECIMAL(18,2)) AS kilos_pedido, CAST(SUM(bruto) AS DECIMAL(18,2)) AS bruto_pedido,
        CAST(SUM(neto) AS DECIMAL(18,2)) AS neto_pedido FROM detalle GROUP BY pedido_id""",
    "envios": """SELECT p.pedido_id, p.cliente_id, p.fecha_pedido, r.*, t.kilos_pedido,
        CAST(r.dias_estimados + p.pedido_id % 2 AS INT) AS dias,
        t.kilos_pedido * r.coste_kg * 0.70 AS transporte
        FROM pedidos p JOIN totales t ON t.pedido_id = p.pedido_id
        JOIN rutas r ON r.ruta_id = (p.pedido_id - 1) % (SELECT COUNT(*) FROM supplier) + 1""",
    "costes_envio": f"""SELECT *, transporte + {_SHIP_FIXED} AS total_log,
        {half_up(f'transporte + {_SHIP_FIXED}', 'kilos_pedido', 4, 'DECIMAL(10,4)', 6)} AS logistico_kg FROM envios""",
    "lotes": f"""SELECT p_partkey + 1 AS lote_id, p_name AS nombre_producto, p_type AS familia_producto, p_brand AS variedad,
        CAST(1995 + p_partkey % 6 AS INT) AS campania_id,
        'Campania_' || CAST(1995 + p_partkey % 6 AS VARCHAR) || '_' || CAST(1996 + p_partkey % 6 AS VARCHAR) AS nombre_campania,
        p_partkey % (SELECT 2 * COUNT(*) FROM supplier) + 1 AS parcela_id,
        (p_partkey % (SELECT 2 * COUNT(*) FROM supplier)) // 2 AS s_suppkey,
        CAST(make_date(1995 + p_partkey % 6, 10, 1) + CAST(p_size AS INT) AS DATE) AS fecha_cosecha,
        {pick(['enviado', 'en_almacen', 'en_campo'], 'p_partkey + 1')} AS estado_lote,
        {_NET_KILOS} AS kilos_lote, {_LOT_TOTAL} AS total_lote,
        {half_up(_LOT_TOTAL, _NET_KILOS, 4, 'DECIMAL(10,4)')} AS producto_kg,
        CASE WHEN 60 + (p_partkey + 1) % 20 >= 70 THEN 'Primera' ELSE 'Segunda' END AS categoria_comercial,
        {pick(['S', 'M', 'L', 'XL'], 'p_partkey + 1')} AS calibre,
        {pick(['GlobalGAP', 'ECO', 'ISO22000', 'GRASP'], 'p_partkey + 1')} AS tipo_certificado
        FROM part""",
    "lineas": """SELECT d.*, e.fecha_pedido, CAST(year(e.fecha_pedido) AS INT) AS anio, CAST(quarter(e.fecha_pedido) AS INT) AS trimestre,
        e.cliente_id, c.pais, c.ciudad, c.nombre_cliente, e.ruta_id, e.nombre_transitario, e.puerto_salida, e.puerto_llegada,
        e.dias, e.logistico_kg, l.nombre_campania, l.campania_id, l.familia_producto, l.nombre_producto, l.variedad, l.producto_kg,
        l.categoria_comercial, l.calibre, l.tipo_certificado, l.parcela_id, l.s_suppkey, s.s_name AS nombre_finca,
        d.kilos * l.producto_kg AS cp, d.kilos * e.logistico_kg AS cl
        FROM detalle d JOIN costes_envio e ON e.pedido_id = d.pedido_id JOIN clientes c ON c.cliente_id = e.cliente_id
        JOIN lotes l ON l.lote_id = d.lote_id JOIN supplier s ON s.s_suppkey = l.s_suppkey""",
    "hechos": f"""SELECT *, CAST(ROUND(cp, 2) AS DECIMAL(12,2)) AS coste_producto, CAST(ROUND(cl, 2) AS DECIMAL(12,2)) AS coste_logistico,
        CAST(ROUND(cp + cl, 2) AS DECIMAL(12,2)) AS coste_total, CAST(ROUND(neto - cp - cl, 2) AS DECIMAL(12,2)) AS margen,
        {half_up_int('neto', 'kilos', 4)} AS precio4 FROM lineas""",
    "dim_tiempo": """SELECT CAST(row_number() OVER (ORDER BY fecha) AS BIGINT) AS tiempo_sk, fecha FROM
        (SELECT DISTINCT fecha_pedido AS fecha FROM pedidos)""",
    "dim_geografia": """SELECT CAST(row_number() OVER (ORDER BY pais, ciudad) AS BIGINT) AS geografia_sk, pais, ciudad FROM
        (SELECT DISTINCT pais, ciudad FROM clientes)""",
    "dim_campania": """SELECT CAST(row_number() OVER (ORDER BY inicio) AS BIGINT) AS campania_sk, CAST(inicio AS INT) AS inicio FROM
        (SELECT year(o_orderdate) - CASE WHEN month(o_orderdate) < 9 THEN 1 ELSE 0 END AS inicio FROM orders
         UNION SELECT 1995 + p_partkey % 6 FROM part)""",
    "dim_finca": """SELECT CAST(row_number() OVER (ORDER BY s_suppkey, mitad) AS BIGINT) AS finca_sk, s_suppkey * 2 + mitad AS parcela_id, s_suppkey, mitad
        FROM supplier CROSS JOIN (SELECT unnest([1, 2]) AS mitad)""",
    "dim_producto": "SELECT CAST(row_number() OVER (ORDER BY p_partkey) AS BIGINT) AS producto_sk, p_partkey + 1 AS lote_id FROM part",
    "dim_cliente": "SELECT CAST(row_number() OVER (ORDER BY c_custkey) AS BIGINT) AS cliente_sk, c_custkey + 1 AS cliente_id FROM customer",
    "dim_logistica": "SELECT CAST(row_number() OVER (ORDER BY s_suppkey) AS BIGINT) AS logistica_sk, s_suppkey + 1 AS ruta_id FROM supplier",
    "hechos_sk": f"""SELECT h.detalle_id, h.pedido_id, t.tiempo_sk, pr.producto_sk, c.cliente_sk, g.geografia_sk, f.finca_sk, pr.producto_sk AS calidad_sk,
        lo.logistica_sk, ca.campania_sk, CAST(h.kilos AS DECIMAL(12,2)) AS kilos_vendidos, h.cajas AS cajas_vendidas, h.bruto AS importe_bruto,
        CAST(h.bruto - h.neto AS DECIMAL(12,2)) AS descuento, h.neto AS importe_neto, h.coste_producto, h.coste_logistico, h.coste_total, h.margen,
        {scaled('h.precio4', 4, 'DECIMAL(12,4)')} AS precio_medio_kg, h.dias AS tiempo_entrega_dias, h.anio AS anio_pedido
        FROM hechos h JOIN dim_tiempo t ON t.fecha = h.fecha_pedido JOIN dim_producto pr ON pr.lote_id = h.lote_id
        JOIN dim_cliente c ON c.cliente_id = h.cliente_id JOIN dim_geografia g ON g.pais = h.pais AND g.ciudad = h.ciudad
        JOIN dim_finca f ON f.parcela_id = h.parcela_id JOIN dim_logistica lo ON lo.ruta_id = h.ruta_id
        JOIN dim_campania ca ON ca.inicio = h.campania_id""",
}


def with_views(last: str, body: str) -> str:
    """``body`` over the views up to and including ``last`` (unused ones cost nothing)."""
    names = list(VIEWS)
    used = names[: names.index(last) + 1]
    needed, frontier = set(), {last, *[n for n in names if _mentions(body, n)]}
    while frontier:
        name = frontier.pop()
        if name in needed:
            continue
        needed.add(name)
        frontier |= {n for n in used if n != name and _mentions(VIEWS[name], n)}
    ctes = ",\n".join(f"{n} AS ({VIEWS[n]})" for n in names if n in needed)
    return f"WITH {ctes}\n{body}"


def _mentions(sql: str, name: str) -> bool:
    import re

    return re.search(rf"\b(FROM|JOIN)\s+{name}\b", sql) is not None
