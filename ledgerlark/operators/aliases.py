"""Canonical measures and the names under which filings state them."""

# Canonical flow measures and their aliases.
FLOW_ALIASES = {
    "ingresos_usd": ["revenues", "revenue", "revenue_usd", "revenue_total", "ingresos_totales", "consolidated_revenue", "ingresos", "total_revenue", "net_revenue", "net_revenues"],
    "cogs_usd": ["cost_of_revenues", "cost_of_revenue", "cogs", "costo_ventas_usd", "cost_of_goods_sold"],
    "gross_profit_usd": ["gross_profit", "gross_profit_usd", "beneficio_bruto", "beneficio_bruto_usd", "utilidad_bruta"],
    "ebit_usd": ["operating_income", "operating_income_usd", "operating_profit", "resultado_operativo", "ingreso_operativo", "beneficio_operativo", "income_from_operations"],
    "net_income_usd": ["net_income", "net_income_usd", "ingreso_neto", "ingreso_neto_consolidado", "ingreso_neto_atribuible_a_travelzoo", "net_income_attributable_to_travelzoo", "net_income_attributable_to_controlling_interest", "net_income_attributable_to_company", "utilidad_neta"],
    "cfo_usd": ["cfo_usd", "net_cash_from_operating_activities", "cash_from_operations", "operating_cash_flow", "flujo_caja_operativo", "cfo"],
    "cfi_usd": ["cfi_usd", "cfi", "cash_from_investing", "net_cash_from_investing_activities", "net_cash_used_in_investing_activities", "investing_activities", "flujo_caja_inversion", "cash_used_in_investing_activities"],
    "cff_usd": ["cff_usd", "cff", "cash_from_financing", "net_cash_from_financing_activities", "net_cash_used_in_financing_activities", "financing_activities", "flujo_caja_financiacion", "cash_used_in_financing_activities"],
    "delta_cash_usd": ["delta_cash_usd", "delta_cash", "cambio_caja_usd", "net_change_in_cash", "net_increase_in_cash", "net_increase_decrease_in_cash", "net_change_in_cash_and_cash_equivalents", "variacion_neta_efectivo", "variacion_neta_caja", "cambio_neto_caja", "cambio_neto_efectivo", "net_increase_decrease_in_cash_and_cash_equivalents"],
    "fx_effect_cash_usd": ["fx_effect_cash_usd", "fx_effect_cash", "effect_of_exchange_rates_on_cash", "effect_of_exchange_rate_changes_on_cash", "exchange_rate_effect_on_cash", "forex_effect_on_cash", "efecto_tipo_cambio_caja_usd", "efecto_tipo_cambio_caja", "efecto_cambiario_caja", "variacion_por_tipo_de_cambio_en_caja"],
    "otros_ajustes_caja_usd": ["otros_ajustes_caja_usd", "otros_ajustes_en_caja", "other_cash_adjustments_usd", "other_cash_adjustments", "other_reconciling_cash_items_usd", "ajustes_otros_cambios_efectivo"],
    "capex_usd": ["capex_usd", "capex", "capital_expenditures", "purchases_of_property_and_equipment", "gastos_capital"],
    "rd_usd": ["research_and_development", "r_and_d", "rd_usd", "product_development", "investigacion_y_desarrollo"],
    "sga_usd": ["sales_and_marketing", "sga_usd", "selling_general_administrative", "gastos_venta_admin"],
    "ga_usd": ["general_and_administrative", "g_and_a", "ga_usd", "gastos_generales_admin"],
    "interest_expense_usd": ["interest_expense", "interest_expense_usd", "gasto_intereses", "gastos_financieros"],
    "depreciation_usd": ["depreciation_and_amortization", "depreciation_usd", "depreciacion_amortizacion", "d_and_a", "da_usd"],
    "income_tax_usd": ["income_tax", "income_tax_expense", "income_tax_usd", "impuesto_renta", "tax_expense"],
}
# Canonical balance-sheet measures and their aliases.
STOCK_ALIASES = {
    "activos_totales_usd": ["total_assets", "total_assets_usd", "activos_totales"],
    "pasivos_totales_usd": ["total_liabilities", "total_liabilities_usd", "pasivos_totales"],
    "patrimonio_usd": ["total_stockholders_equity", "total_shareholders_equity", "equity_usd", "equity", "patrimonio", "patrimonio_neto"],
    "deuda_total_usd": ["total_debt", "deuda_total", "long_term_debt", "deuda_largo_plazo"],
    "caja_usd": ["cash_and_cash_equivalents", "cash_usd", "cash", "efectivo_equivalentes", "caja_y_equivalentes"],
    "cuentas_por_cobrar_usd": ["accounts_receivable_usd", "accounts_receivable", "cuentas_por_cobrar", "trade_receivables"],
    "inventarios_usd": ["inventories_usd", "inventories", "inventarios"],
    "cuentas_por_pagar_usd": ["accounts_payable_usd", "accounts_payable", "cuentas_por_pagar"],
}
# Keys that hold lower-level entries.
NESTING_KEYS = ["metricas", "datos", "estado_resultados", "metrics", "income_statement", "line_items"]
# Filing types by authority.
FILING_PRIORITY = {
    "10-K": 1, "20-F": 1, "ANNUAL_REPORT": 1,
    "10-Q": 2, "6-K": 2, "INTERIM_REPORT": 2,
    "8-K": 3, "REGULATORY_FILING": 3,
    "TRANSCRIPT": 4,
    "PRESENTATION": 5, "INVESTOR_PRESENTATION": 5,
    "DEF14A": 6,
    "IR_NEWS": 7, "OTHER": 8,
}
UNKNOWN_PRIORITY = 99
# Most filings taken per type; any other type has the default.
TYPE_CAPS = {"10-K": 5, "20-F": 5, "10-Q": 8, "6-K": 8, "8-K": 4, "DEF14A": 1, "EARNINGS_TRANSCRIPT": 6, "TRANSCRIPT": 6, "PRESENTATION": 3}
DEFAULT_CAP = 3


def alias_pairs(aliases: dict[str, list[str]]) -> list[tuple[str, str]]:
    """(lower-case alias, canonical), the canonical name being an alias of itself."""
    return sorted({(a.lower(), c) for c, names in aliases.items() for a in [*names, c]})
