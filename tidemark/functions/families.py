"""Feature families as named SQL expressions over filing fields, their lags, market inputs and returns.

``x`` is the value of the filing known at the snapshot, ``x_t1`` to ``x_t3``
those of one to three years before.  A ratio is null unless its denominator is
positive; a score is null if any part is.  The expressions are plain SQL, so a
family is one projection.
"""

from __future__ import annotations

import re

# Fields of a filing, states first, then flows of twelve months.
LEVELS = "assets assetsc cashneq receivables inventory ppnenet investments liabilities liabilitiesc debt debtnc equity retearn workingcapital tangibles invcap sharesbas sharefactor".split()
FLOWS = "revenue gp sgna depamor ebit ebitda intexp netinc ncfo fcf ncfcommon ncfdebt ncfdiv epsdil rnd capex".split()


def div(n: str, d: str) -> str:
    return f"(CASE WHEN ({d}) > 0 THEN ({n}) / ({d}) END)"


def ln(x: str) -> str:
    return f"(CASE WHEN ({x}) > 0 THEN ln({x}) END)"


def lag(e: str, k: int) -> str:
    """The expression with every filing field taken k years earlier."""
    return re.sub(r"\b(" + "|".join(LEVELS + FLOWS) + r")\b", rf"\1_t{k}", e)


def change(e: str, k: int = 1) -> str:
    return f"({e} - {lag(e, k)})"


def flag(cond: str) -> str:
    return f"({cond})"


def whole(cond: str) -> str:
    return f"CAST(({cond}) AS INT)"


def spread(*parts: str) -> str:
    """Sample deviation across the parts, null if any is; equal parts give exactly 0."""
    n = len(parts)
    mean = f"(({' + '.join(parts)}) / {n})"
    total = " + ".join(f"({p} - {mean}) * ({p} - {mean})" for p in parts)
    known = " AND ".join(f"{p} IS NOT NULL" for p in parts)
    same = " AND ".join(f"{p} = {parts[0]}" for p in parts[1:])
    return f"(CASE WHEN {known} THEN CASE WHEN {same} THEN CAST(0 AS DOUBLE) ELSE sqrt(({total}) / {n - 1}) END END)"


MARGIN, ROA, TURNOVER, CURRENT = div("gp", "revenue"), div("netinc", "assets"), div("revenue", "assets"), div("assetsc", "liabilitiesc")
LEVERAGE, DEBT_RATE = div("debtnc", "assets"), div("debt + liabilitiesc", "assets")
WC, RE, EBIT_TA, TL_TA = div("workingcapital", "assets"), div("retearn", "assets"), div("ebit", "assets"), div("liabilities", "assets")
GROWTH = [f"({div('revenue', 'revenue_t1')} - 1)", f"({div('revenue_t1', 'revenue_t2')} - 1)", f"({div('revenue_t2', 'revenue_t3')} - 1)"]
LOSS2 = "netinc < 0 AND netinc_t1 < 0"
NI_CHANGE = div("netinc - netinc_t1", "abs(netinc) + abs(netinc_t1)")
SOFT, DEPRECIATION = "(1 - " + div("assetsc + ppnenet", "assets") + ")", div("depamor", "depamor + ppnenet")
DSRI, SGI, SGAI, LVGI = (div(e, lag(e, 1)) for e in (div("receivables", "revenue"), "revenue", div("sgna", "revenue"), DEBT_RATE))
AQI, DEPI = div(SOFT, lag(SOFT, 1)), div(lag(DEPRECIATION, 1), DEPRECIATION)
GMI = f"(CASE WHEN {lag(MARGIN, 1)} > 0 THEN {div(lag(MARGIN, 1), MARGIN)} END)"
ACCRUALS = div("netinc - ncfo", "assets")

FAMILIES: dict[str, dict[str, str]] = {
    "valuation": {
        "earnings_yield": div("netinc", "marketcap"), "ocf_yield": div("ncfo", "marketcap"), "fcf_yield": div("fcf", "marketcap"), "sales_yield": div("revenue", "marketcap"),
        "book_to_market": div("equity", "marketcap"), "tangible_book_to_market": div("tangibles", "marketcap"), "ebit_to_ev": div("ebit", "ev"), "ebitda_to_ev": div("ebitda", "ev"),
        "dividend_yield": div("-ncfdiv", "marketcap"), "net_payout_yield": div("-(ncfdiv + ncfcommon)", "marketcap"), "ncav_to_marketcap": div("assetsc - liabilities", "marketcap"), "ev_to_marketcap": div("ev", "marketcap"),
    },
    "profitability": {
        "gp_to_assets": div("gp", "assets"), "roa": ROA, "roe": div("netinc", "equity"), "ebit_to_invcap": div("ebit", "invcap"), "roc_greenblatt": div("ebit", "workingcapital + ppnenet"), "gross_margin": MARGIN,
        "operating_margin": div("ebit", "revenue"), "net_margin": div("netinc", "revenue"), "fcf_margin": div("fcf", "revenue"), "cfo_to_assets": div("ncfo", "assets"), "asset_turnover": TURNOVER,
    },
    "growth": {
        "revenue_growth_1y": GROWTH[0], "revenue_growth_3y": f"(CASE WHEN revenue_t3 > 0 AND revenue >= 0 THEN pow({div('revenue', 'revenue_t3')}, 1 / CAST(3 AS DOUBLE)) - 1 END)", "epsdil_growth_1y": f"({div('epsdil', 'epsdil_t1')} - 1)",
        "roa_delta_1y": change(ROA), "gross_margin_delta_1y": change(MARGIN), "gross_margin_delta_2y": change(MARGIN, 2), "asset_turnover_delta_1y": change(TURNOVER), "asset_growth_1y": f"({div('assets', 'assets_t1')} - 1)",
        "share_count_growth_1y": f"({div('sharesbas * sharefactor', 'sharesbas_t1 * sharefactor_t1')} - 1)",
    },
    "solvency": {
        "wc_to_assets": WC, "retearn_to_assets": RE, "ebit_to_assets": EBIT_TA, "marketcap_to_liabilities": div("marketcap", "liabilities"), "equity_to_liabilities": div("equity", "liabilities"), "liabilities_to_assets": TL_TA,
        "cl_to_ca": div("liabilitiesc", "assetsc"), "current_ratio": CURRENT, "quick_ratio": div("assetsc - inventory", "liabilitiesc"), "cash_to_assets": div("cashneq", "assets"), "debt_to_equity": div("debt", "equity"),
        "net_debt_to_ebitda": div("debt - cashneq", "ebitda"), "interest_coverage": div("ebit", "intexp"), "ffo_to_liabilities": div("ncfo", "liabilities"), "log_assets": ln("assets"), "ni_change_scaled": NI_CHANGE,
        "two_year_loss": flag(LOSS2), "liab_gt_assets": flag("liabilities > assets"),
        "altman_z": f"1.2 * {WC} + 1.4 * {RE} + 3.3 * {EBIT_TA} + 0.6 * {div('marketcap', 'liabilities')} + {TURNOVER}",
        "altman_z_dd": f"6.56 * {WC} + 3.26 * {RE} + 6.72 * {EBIT_TA} + 1.05 * {div('equity', 'liabilities')}",
        "zmijewski": f"-4.336 - 4.513 * {ROA} + 5.679 * {TL_TA} + 0.004 * {CURRENT}",
        "ohlson_o": f"-1.32 - 0.407 * {ln('assets / 1000000')} + 6.03 * {TL_TA} - 1.43 * {WC} + 0.0757 * {div('liabilitiesc', 'assetsc')} - 1.72 * {whole('liabilities > assets')} - 2.37 * {ROA} - 1.83 * {div('ncfo', 'liabilities')} + 0.285 * {whole(LOSS2)} - 0.521 * {NI_CHANGE}",
    },
    "quality": {
        "dsri": DSRI, "gmi": GMI, "aqi": AQI, "sgi": SGI, "depi": DEPI, "sgai": SGAI, "lvgi": LVGI, "accruals_to_assets": ACCRUALS,
        "beneish_m": f"-4.84 + 0.92 * {DSRI} + 0.528 * {GMI} + 0.404 * {AQI} + 0.892 * {SGI} + 0.115 * {DEPI} - 0.172 * {SGAI} + 4.679 * {ACCRUALS} - 0.327 * {LVGI}",
        "piotroski_roa_positive": flag(f"{ROA} > 0"), "piotroski_cfo_positive": flag("ncfo > 0"), "piotroski_roa_up": flag(f"{ROA} > {lag(ROA, 1)}"), "piotroski_cfo_gt_ni": flag("ncfo > netinc"),
        "piotroski_leverage_down": flag(f"{LEVERAGE} < {lag(LEVERAGE, 1)}"), "piotroski_liquidity_up": flag(f"{CURRENT} > {lag(CURRENT, 1)}"), "piotroski_no_issuance": flag("ncfcommon <= 0"),
        "piotroski_margin_up": flag(f"{MARGIN} > {lag(MARGIN, 1)}"), "piotroski_turnover_up": flag(f"{TURNOVER} > {lag(TURNOVER, 1)}"),
        "noa_to_assets": div("(assets - cashneq - investments) - (liabilities - debt)", "assets_t1"), "ext_financing_to_assets": div("ncfcommon + ncfdebt", "assets"), "rnd_to_assets": div("coalesce(rnd, 0)", "assets"),
        "capex_to_assets": div("-capex", "assets"), "roa_variability_3y": spread(ROA, lag(ROA, 1), lag(ROA, 2), lag(ROA, 3)), "revenue_growth_variability_3y": spread(*GROWTH),
    },
}
FAMILIES["quality"]["piotroski_f"] = " + ".join(whole(e[1:-1]) for n, e in FAMILIES["quality"].items() if n.startswith("piotroski_"))


def columns(family: str) -> list[str]:
    return list(FAMILIES[family])


def lagged_fields() -> list[str]:
    """Fields that any expression uses from an earlier year."""
    return sorted(set(re.findall(r"\b([a-z]+)_t[123]\b", " ".join(e for f in FAMILIES.values() for e in f.values()))))
