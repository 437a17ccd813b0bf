"""Source names, staging models, star schema and catalogs.

Names, types and widths are the published data contract, in its own order.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import types as T


class Field(NamedTuple):
    source: str
    name: str
    type: str
    width: int | None = None


PRICES = (
    Field("Mes", "mes", "int"),
    Field("Año", "ano", "int"),
    Field("Empresa", "empresa", "string", 25),
    Field("Tarifa", "tarifa", "string", 50),
    Field("Abonados", "abonados", "double"),
    Field("Ventas", "ventas", "double"),
    Field("Ingreso sin CVG", "ingreso_sin_cvg", "double"),
    Field("Ingreso con CVG", "ingreso_con_cvg", "double"),
    Field("Precio Medio sin CVG", "precio_medio_sin_cvg", "double"),
    Field("Precio Medio con CVG", "precio_medio_con_cvg", "double"),
    Field("Trimestre", "trimestre", "string", 20),
    Field("Sistema", "sistema", "string", 20),
    Field("Trimestral", "trimestral", "string", 10),
)

CLIMATE_VARIABLES = (
    "T2M", "WS10M", "CLOUD_AMT", "RH2M", "T2M_MAX", "T2M_MIN", "CLOUD_OD", "GWETROOT", "TS",
    "PRECTOTCORR", "ALLSKY_SFC_SW_DWN", "PS", "T2MWET", "ALLSKY_SFC_SW_DIFF", "ALLSKY_SFC_LW_DWN",
)
CLIMATE_MEASURES = tuple(v.lower() for v in CLIMATE_VARIABLES)

CLIMATE = (
    Field("Empresa", "empresa", "string", 20),
    Field("Año", "ano", "int"),
    Field("Mes", "mes", "int"),
    *(Field(v, v.lower(), "double") for v in CLIMATE_VARIABLES),
)

PLANTS = (
    Field("id_Objecto", "id_objecto", "int"),
    Field("operador", "operador", "string", 100),
    Field("centralElectrica", "central_electrica", "string", 100),
    Field("fuente", "fuente", "string", 50),
    Field("provincia", "provincia", "string", 50),
    Field("canton", "canton", "string", 50),
    Field("distrito", "distrito", "string", 50),
    Field("codigoDTA", "codigo_dta", "int"),
    Field("coordenadaX", "coordenada_x", "double"),
    Field("coordenadaY", "coordenada_y", "double"),
)

ZONES = (
    Field("id_Objecto", "id_objecto", "int"),
    Field("operador", "operador", "string", 100),
    Field("descripcion", "descripcion", "string", 200),
    Field("area", "area", "decimal(18,8)"),
    Field("coordenadas", "coordenadas", "string"),
    Field("tipo_geometria", "tipo_geometria", "string", 20),
)

DISTRIBUTION = (
    Field("id_Mes", "id_mes", "int"),
    Field("mes", "mes", "string", 15),
    Field("anho", "anho", "int"),
    Field("fecha", "fecha", "date"),
    Field("empresa", "empresa", "string", 25),
    Field("tipoTarifa", "tipo_tarifa", "string", 20),
    Field("descripcionTarifa", "descripcion_tarifa", "string", 120),
    Field("bloque", "bloque", "string", 120),
    Field("tarifaPromedio", "tarifa_promedio", "double"),
    Field("tarifa", "tarifa", "double"),
    Field("pliego", "pliego", "string", 120),
    Field("estructuraCostos", "estructura_costos", "string", 150),
    Field("numeroExpediente", "numero_expediente", "string", 50),
    Field("numeroResolucion", "numero_resolucion", "string", 50),
    Field("fechaPublicacion", "fecha_publicacion", "date"),
)

FUELS = (
    Field("numeroExpediente", "numero_expediente", "string", 50),
    Field("numeroResolucion", "numero_resolucion", "string", 50),
    Field("fechaPublicacion", "fecha_publicacion", "date"),
    Field("alcanceGaceta", "alcance_gaceta", "string", 20),
    Field("numeroGaceta", "numero_gaceta", "int"),
    Field("producto", "producto", "string", 100),
    Field("tipoCambio", "tipo_cambio", "double"),
    Field("precioReferenciaInternacional", "precio_referencia_internacional", "double"),
    Field("precioColonizado", "precio_colonizado", "double"),
    Field("otrosIngresosProrrateados", "otros_ingresos_prorrateados", "double"),
    Field("asigCruzPesc", "asig_cruz_pesc", "double"),
    Field("asigCruzMinae", "asig_cruz_minae", "double"),
    Field("subCruzPesc", "sub_cruz_pesc", "double"),
    Field("subCruzMinae", "sub_cruz_minae", "double"),
    Field("diferencialPrecios", "diferencial_precios", "double"),
    Field("impuestoUnico", "impuesto_unico", "double"),
    Field("canon", "canon", "double"),
    Field("margenOperacion", "margen_operacion", "double"),
    Field("rendTarif", "rend_tarif", "double"),
    Field("precioPlantelSinImpuesto", "precio_plantel_sin_impuesto", "double"),
    Field("precioConImpuesto", "precio_con_impuesto", "double"),
    Field("margenEstacionesTerrestres", "margen_estaciones_terrestres", "double"),
    Field("margenEstacionesAereas", "margen_estaciones_aereas", "double"),
    Field("fleteEstaciones", "flete_estaciones", "double"),
    Field("margenEnvasador", "margen_envasador", "double"),
    Field("margenDistribuidos", "margen_distribuidor", "double"),
    Field("margenDetallista", "margen_detallista", "double"),
    Field("rige", "rige", "boolean"),
    Field("precioConsumidorFinalGas", "precio_consumidor_final_gas", "double"),
    Field("precioFinal", "precio_final", "double"),
    Field("precioFinalSinPuntoFijo", "precio_final_sin_punto_fijo", "double"),
)
FUEL_MEASURES = tuple(f.name for f in FUELS if f.type == "double")

STAGING = {
    "stg_clima_nasa": CLIMATE,
    "stg_aresep_medios": PRICES,
    "stg_centro": PLANTS,
    "stg_zonas": ZONES,
    "stg_distribucion": DISTRIBUTION,
    "stg_hidrocarburos": FUELS,
}

# Staging columns filled at load time: table -> column -> (type, SQL default).
STAGING_DEFAULTS = {
    "stg_zonas": {"srid": ("int", "5367"), "fecha_carga": ("timestamp", "current_timestamp()")},
}

# Source columns a recipe keeps, where it keeps fewer than the model has.
DISTRIBUTION_LAYOUT = (
    "id_Mes", "mes", "anho", "empresa", "tipoTarifa", "descripcionTarifa", "bloque",
    "tarifaPromedio",
)
FUEL_DROPPED = ("observaciones", "idSIET")
PLANT_REQUIRED = ("operador", "coordenadaX", "coordenadaY")
ZONE_REQUIRED = ("operador", "descripcion", "area", "coordenadas")

# Star schema: table -> (surrogate key, natural key or grain, other columns).
MEASURE = "decimal(18,6)"

DIMENSIONS = {
    "dim_tiempo": (
        "tiempo_key", "fecha",
        "fecha date, anio int, mes int, dia int, trimestre int, nombre_mes string, anio_mes int",
    ),
    "dim_empresa": ("empresa_key", "nombre_empresa", "nombre_empresa string"),
    "dim_tarifa": (
        "tarifa_key", "tarifa_nk",
        "tarifa_nk string, nombre_tarifa string, tipo_tarifa string, descripcion_tarifa string,"
        " bloque string, sistema string, indicador_trimestral string",
    ),
    "dim_ubicacion": (
        "ubicacion_key", "ubicacion_nk",
        "ubicacion_nk string, provincia string, canton string, distrito string, codigo_dta int,"
        " coordenada_x double, coordenada_y double",
    ),
    "dim_central_electrica": (
        "central_key", "id_objecto",
        "id_objecto int, operador string, central_electrica string, fuente string,"
        " ubicacion_key bigint",
    ),
    "dim_producto_hidrocarburo": ("producto_key", "producto", "producto string"),
    "dim_resolucion_hidrocarburo": (
        "resolucion_key", "resolucion_nk",
        "resolucion_nk string, numero_expediente string, numero_resolucion string,"
        " fecha_publicacion date, alcance_gaceta string, numero_gaceta int, rige boolean",
    ),
    "dim_zona_concesion": (
        "zona_key", "id_objecto",
        "id_objecto int, operador string, descripcion string, area decimal(18,8),"
        " coordenadas_wkt string, tipo_geometria string, srid int",
    ),
}

TARIFF_MEASURES = (
    "abonados", "ventas", "ingreso_sin_cvg", "ingreso_con_cvg", "precio_medio_sin_cvg",
    "precio_medio_con_cvg",
)

FACTS = {
    "fact_clima_mensual": (
        "fact_clima_key", ("tiempo_key", "empresa_key"), CLIMATE_MEASURES,
    ),
    "fact_tarifa_electricidad": (
        "fact_tarifa_key", ("tiempo_key", "empresa_key", "tarifa_key"), TARIFF_MEASURES,
    ),
    "fact_distribucion_tarifaria": (
        "fact_distribucion_key", ("tiempo_key", "empresa_key", "tarifa_key"), ("tarifa_promedio",),
    ),
    "fact_hidrocarburos": (
        "fact_hidrocarburo_key", ("tiempo_key", "producto_key", "resolucion_key"), FUEL_MEASURES,
    ),
}
BRIDGE = ("bridge_empresa_zona", "bridge_empresa_zona_key", ("empresa_key", "zona_key"))

# Text widths of the star that are tighter than, or absent from, staging.
STAR_WIDTHS = {
    "dim_empresa": {"nombre_empresa": 100},
    "dim_tarifa": {
        "tarifa_nk": 500, "nombre_tarifa": 100, "tipo_tarifa": 50, "descripcion_tarifa": 150,
        "bloque": 100, "sistema": 50, "indicador_trimestral": 20,
    },
    "dim_ubicacion": {"ubicacion_nk": 500, "provincia": 100, "canton": 100, "distrito": 100},
    "dim_central_electrica": {"operador": 150, "central_electrica": 150, "fuente": 100},
    "dim_producto_hidrocarburo": {"producto": 150},
    "dim_resolucion_hidrocarburo": {
        "resolucion_nk": 300, "numero_expediente": 50, "numero_resolucion": 50,
        "alcance_gaceta": 20,
    },
    "dim_zona_concesion": {"operador": 100, "descripcion": 200, "tipo_geometria": 20},
}

# Catalogs: file -> (table, columns as published); table columns are the same in lower case.
_CATALOG = (
    "ID", "Name", "Tags", "Services", "Availability", "Description", "Keywords",
    "Warnings_API_Original",
)
_CLIMATE_CATALOG = (
    "ID", "Name_ES", "Name_EN", "Tags", "Services", "Availability", "Description", "Alternates",
    "Keywords", "Warnings",
)
CATALOGS = {
    "aresep_centrales_electricas_variables.csv": (
        "catalogo_centrales_electricas_variables", _CATALOG,
    ),
    "aresep_hidrocarburos_variables.csv": ("catalogo_hidrocarburos_variables", _CATALOG),
    "aresep_tarifas_electricidad_distribucion_variables.csv": (
        "catalogo_tarifas_electricidad_distribucion_variables", _CATALOG,
    ),
    "aresep_tarifas_precios_medios_variables.csv": (
        "catalogo_tarifas_precios_medios_variables", _CATALOG,
    ),
    "aresep_zonas_concesion_operador_variables.csv": (
        "catalogo_zonas_concesion_operador_variables", _CATALOG,
    ),
    "nasa_power_parameters_name_es.csv": ("catalogo_clima_variables", _CLIMATE_CATALOG),
}


def layout(fields: tuple[Field, ...]) -> list[str]:
    """Source names in model order."""
    return [f.source for f in fields]


def text_schema(names) -> T.StructType:
    """All-string schema, for lenient reads."""
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


def staging_schema(fields: tuple[Field, ...]) -> str:
    return ", ".join(f"{f.name} {f.type}" for f in fields)
