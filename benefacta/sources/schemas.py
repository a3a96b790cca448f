"""Raw and conformed layouts of the three client tables and of the external series.

A layout is a list of ``Field``: the header in the client file, the header the cleaned CSV files
use, the column name inside this package, and the type after conforming.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import types as T


class Field(NamedTuple):
    raw: str
    published: str
    name: str
    kind: str  # long | int | double | bool | string | date


# Headers of the client files and of the cleaned files.
DONORS = [
    Field("PSN", "ID_Donante", "donor_id", "long"),
    Field("Fecha de nacimiento", "DT_Nacimiento", "birth_date", "date"),
    Field("Fecha de Captación", "DT_Captacion", "capture_date", "date"),
    Field("Fecha Aniversario Pago", "DT_Aniversario_Pago", "payment_anniversary", "date"),
    Field("Edad", "VL_Edad", "age", "int"),
    Field("Cantidad de Hijos", "VL_Num_Hijos", "children", "int"),
    Field("Tiene hijos", "CD_Tiene_Hijos", "has_children", "bool"),
    Field("Churn Probability", "VL_Churn_Prob", "churn_prob", "double"),
    Field("Lapsed Probability", "VL_Lapsed_Prob", "lapsed_prob", "double"),
    Field("Donante Activo", "CD_Donante_Activo", "is_active", "bool"),
    Field("Tipo de registro del contacto", "CD_Tipo_Registro", "contact_type", "string"),
    Field("Género", "FK_ID_Genero", "gender", "string"),
    Field("Estado Civil", "FK_ID_Estado_Civil", "marital_status", "string"),
    Field("Ocupación", "FK_ID_Ocupacion", "occupation", "string"),
    Field("Otra Clasificación RFM Actual", "FK_ID_Segmento_RFM", "rfm_segment", "string"),
    Field("Cantidad Cuotas Pagadas Global", "VL_Cuotas_Pagadas", "instalments_paid", "int"),
    Field("Cantidad Cuotas No Pagadas Global", "VL_Cuotas_No_Pagadas", "instalments_unpaid", "int"),
    Field("Campaña Inicial: Nombre", "FK_ID_Campana", "campaign", "string"),
    Field("Ciudad de correo", "CD_Ciudad", "city", "string"),
    Field("Estado o provincia de correo", "CD_Departamento", "department", "string"),
    Field("Monto Actual", "Monto Actual", "current_amount", "double"),
]

TRANSACTIONS = [
    Field("PSN", "FK_ID_Donante", "donor_id", "long"),
    Field("Fecha de Donación", "DT_Fecha", "tx_date", "date"),
    Field("Fecha de Registro Contable", "DT_Registro_Contable", "booking_date", "date"),
    Field("Fecha efectiva de primer cobro", "DT_Primer_Cobro", "first_charge", "date"),
    Field("Fecha de última donación", "DT_Ultima_Donacion", "last_donation", "date"),
    Field("Importe", "VL_Importe", "amount", "double"),
    Field("Etapa", "FK_CD_Etapa", "stage", "string"),
    Field("Canal de la Campaña", "FK_CD_Canal_campana", "campaign_channel", "string"),
    Field("Estado/Tipo", "FK_CD_Estado", "status", "string"),
    Field("Tipo de Compromiso", "FK_CD_Compromiso", "commitment", "string"),
    Field("Medio de Pago", "FK_CD_Medio_Pago", "payment_method", "string"),
    Field("Tipo de registro", "FK_CD_Registro", "record_type", "string"),
]

CANCELLATIONS = [
    Field("PSN", "ID_Donante", "donor_id", "long"),
    Field("Fecha de Baja", "DT_Cancelacion", "cancel_date", "date"),
    Field("Fecha efectiva de primer cobro", "DT_Primer_Cobro", "first_charge", "date"),
    Field("Fecha de última donación", "DT_Ultima_Donacion", "last_donation", "date"),
    Field("Motivo de Baja", "CD_Motivo_Cancelacion", "reason", "string"),
    Field("Estado/Tipo", "CD_Estado", "status", "string"),
]

LIFETIME_VALUE = [
    Field("ID_Donante", "ID_Donante", "donor_id", "long"),
    Field("Valor_Total", "Valor_Total", "total_value", "double"),
    Field("Anio_Donacion", "Anio_Donacion", "first_year", "int"),
    Field("VL_Lifespan", "VL_Lifespan", "lifespan", "double"),
    Field("VL_Edad", "VL_Edad", "age", "int"),
    Field("VL_NChurn", "VL_NChurn", "churn_max", "double"),
    Field("Ant_Primer_Transaccion", "Ant_Primer_Transaccion", "tenure_years", "int"),
    Field("Total_Anual", "Total_Anual", "yearly_average", "double"),
    Field("DLTV", "DLTV", "dltv", "double"),
]

# Headers of the monthly inflation export.
INFLATION_PERIOD = "Año(aaaa)-Mes(mm)"
INFLATION_RATE = "Inflación total 1"

REQUEST_BODY = T.StructType([
    T.StructField("inputs", T.ArrayType(T.StructType([
        T.StructField("Churn", T.StringType()),
        T.StructField("DLTV", T.StringType()),
        T.StructField("Efectividad_cobro", T.StringType()),
    ]))),
])


def raw_schema(layout: list[Field]) -> T.StructType:
    """All columns as text: numbers and dates in the client files contain words."""
    return T.StructType([T.StructField(f.raw, T.StringType()) for f in layout])
