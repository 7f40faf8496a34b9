"""Column names of the raw contracts."""

# The raw contract columns, in the order of the source, and those of them that are dates.
RAW_COLUMNS = (
    "id", "nombre_entidad", "nit_entidad", "departamento", "ciudad", "orden", "proceso_de_compra", "referencia_del_contrato",
    "estado_contrato", "descripcion_del_proceso", "modalidad_de_contratacion", "fecha_de_firma",
    "fecha_de_inicio_del_contrato", "fecha_de_fin_del_contrato", "tipodocproveedor", "documento_proveedor",
    "proveedor_adjudicado", "valor_del_contrato", "objeto_del_contrato", "dias_adicionados")
RAW_DATES = ("fecha_de_firma", "fecha_de_inicio_del_contrato", "fecha_de_fin_del_contrato")

# The columns of the projection that models start from.
MODEL_COLUMNS = (
    "index", "full_contract_description", "proceso_de_compra", "orden", "modalidad_de_contratacion", "duration_days",
    "Poblacion", "PIB", "ValorAgregado", "Impuestos", "log_valor_del_contrato", "dias_adicionados", "days_ref")

TEXT_COLUMNS = tuple(c for c in RAW_COLUMNS if c != "id" and c not in RAW_DATES)
