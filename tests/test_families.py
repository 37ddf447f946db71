"""Whole families against formulas written out by hand in plain Python, on rows with missing, zero and negative values."""

import math
import random
from statistics import stdev

import pytest

from tidemark.functions.families import FAMILIES, FLOWS, LEVELS
from tidemark.functions.registry import columns
from tidemark.operators.fundamentals import family


def div(a, b):
    return None if a is None or b is None or b <= 0 else a / b


def op(f, *xs):
    return None if any(x is None for x in xs) else f(*xs)


def sub(a, b):
    return op(lambda x, y: x - y, a, b)


def add(*xs):
    return op(lambda *y: sum(y), *xs)


def neg(a):
    return op(lambda x: -x, a)


def log(a):
    return None if a is None or a <= 0 else math.log(a)


def lin(*terms):
    """Sum of weight * value, None if any value is."""
    return None if any(v is None for _, v in terms) else sum(w * v for w, v in terms)


def gt(a, b):
    return op(lambda x, y: x > y, a, b)


def both(p, q):
    return False if p is False or q is False else None if p is None or q is None else True


class Year:
    """The fields of one year, and ratios of it."""

    def __init__(self, row, k):
        self.f = {n: row[n if k == 0 else f"{n}_t{k}"] for n in LEVELS + FLOWS}

    def __getattr__(self, name):
        return self.f[name]

    def margin(self):
        return div(self.gp, self.revenue)

    def roa(self):
        return div(self.netinc, self.assets)

    def turnover(self):
        return div(self.revenue, self.assets)

    def current(self):
        return div(self.assetsc, self.liabilitiesc)

    def soft(self):
        return sub(1, div(add(self.assetsc, self.ppnenet), self.assets))

    def wear(self):
        return div(self.depamor, add(self.depamor, self.ppnenet))


def expected(row):
    t, u, v, w = (Year(row, k) for k in range(4))
    mc, ev = row["marketcap"], row["ev"]
    o = {
        "earnings_yield": div(t.netinc, mc), "ocf_yield": div(t.ncfo, mc), "fcf_yield": div(t.fcf, mc), "sales_yield": div(t.revenue, mc), "book_to_market": div(t.equity, mc), "tangible_book_to_market": div(t.tangibles, mc),
        "ebit_to_ev": div(t.ebit, ev), "ebitda_to_ev": div(t.ebitda, ev), "dividend_yield": div(neg(t.ncfdiv), mc), "net_payout_yield": div(neg(add(t.ncfdiv, t.ncfcommon)), mc), "ncav_to_marketcap": div(sub(t.assetsc, t.liabilities), mc), "ev_to_marketcap": div(ev, mc),
        "gp_to_assets": div(t.gp, t.assets), "roa": t.roa(), "roe": div(t.netinc, t.equity), "ebit_to_invcap": div(t.ebit, t.invcap), "roc_greenblatt": div(t.ebit, add(t.workingcapital, t.ppnenet)), "gross_margin": t.margin(), "operating_margin": div(t.ebit, t.revenue),
        "net_margin": div(t.netinc, t.revenue), "fcf_margin": div(t.fcf, t.revenue), "cfo_to_assets": div(t.ncfo, t.assets), "asset_turnover": t.turnover(),
    }
    yoy = [sub(div(a.revenue, b.revenue), 1) for a, b in ((t, u), (u, v), (v, w))]
    o["revenue_growth_1y"] = yoy[0]
    o["revenue_growth_3y"] = None if None in (t.revenue, w.revenue) or w.revenue <= 0 or t.revenue < 0 else (t.revenue / w.revenue) ** (1 / 3) - 1
    o |= {"epsdil_growth_1y": sub(div(t.epsdil, u.epsdil), 1), "roa_delta_1y": sub(t.roa(), u.roa()), "gross_margin_delta_1y": sub(t.margin(), u.margin()), "gross_margin_delta_2y": sub(t.margin(), v.margin()), "asset_turnover_delta_1y": sub(t.turnover(), u.turnover()), "asset_growth_1y": sub(div(t.assets, u.assets), 1)}
    shares = lambda y: op(lambda a, b: a * b, y.sharesbas, y.sharefactor)
    o["share_count_growth_1y"] = sub(div(shares(t), shares(u)), 1)
    wc, re, eb, tl = div(t.workingcapital, t.assets), div(t.retearn, t.assets), div(t.ebit, t.assets), div(t.liabilities, t.assets)
    o |= {"wc_to_assets": wc, "retearn_to_assets": re, "ebit_to_assets": eb, "marketcap_to_liabilities": div(mc, t.liabilities), "equity_to_liabilities": div(t.equity, t.liabilities), "liabilities_to_assets": tl, "cl_to_ca": div(t.liabilitiesc, t.assetsc), "current_ratio": t.current()}
    o |= {"quick_ratio": div(sub(t.assetsc, t.inventory), t.liabilitiesc), "cash_to_assets": div(t.cashneq, t.assets), "debt_to_equity": div(t.debt, t.equity), "net_debt_to_ebitda": div(sub(t.debt, t.cashneq), t.ebitda), "interest_coverage": div(t.ebit, t.intexp), "ffo_to_liabilities": div(t.ncfo, t.liabilities), "log_assets": log(t.assets)}
    o["ni_change_scaled"] = div(sub(t.netinc, u.netinc), op(lambda a, b: abs(a) + abs(b), t.netinc, u.netinc))
    o["two_year_loss"], o["liab_gt_assets"] = both(gt(0, t.netinc), gt(0, u.netinc)), gt(t.liabilities, t.assets)
    o["altman_z"] = lin((1.2, wc), (1.4, re), (3.3, eb), (0.6, o["marketcap_to_liabilities"]), (1.0, t.turnover()))
    o["altman_z_dd"] = lin((6.56, wc), (3.26, re), (6.72, eb), (1.05, o["equity_to_liabilities"]))
    o["zmijewski"] = lin((-4.336, 1), (-4.513, t.roa()), (5.679, tl), (0.004, t.current()))
    o["ohlson_o"] = lin((-1.32, 1), (-0.407, log(op(lambda a: a / 1e6, t.assets))), (6.03, tl), (-1.43, wc), (0.0757, o["cl_to_ca"]), (-1.72, o["liab_gt_assets"]), (-2.37, t.roa()), (-1.83, o["ffo_to_liabilities"]), (0.285, o["two_year_loss"]), (-0.521, o["ni_change_scaled"]))
    rate = lambda y: div(add(y.debt, y.liabilitiesc), y.assets)
    o |= {"dsri": div(div(t.receivables, t.revenue), div(u.receivables, u.revenue)), "gmi": div(u.margin(), t.margin()) if u.margin() is not None and u.margin() > 0 else None, "aqi": div(t.soft(), u.soft()), "sgi": div(t.revenue, u.revenue), "depi": div(u.wear(), t.wear()), "sgai": div(div(t.sgna, t.revenue), div(u.sgna, u.revenue)), "lvgi": div(rate(t), rate(u))}
    o["accruals_to_assets"] = div(sub(t.netinc, t.ncfo), t.assets)
    o["beneish_m"] = lin((-4.84, 1), (0.92, o["dsri"]), (0.528, o["gmi"]), (0.404, o["aqi"]), (0.892, o["sgi"]), (0.115, o["depi"]), (-0.172, o["sgai"]), (4.679, o["accruals_to_assets"]), (-0.327, o["lvgi"]))
    lev = lambda y: div(y.debtnc, y.assets)
    flags = {"roa_positive": gt(t.roa(), 0), "cfo_positive": gt(t.ncfo, 0), "roa_up": gt(t.roa(), u.roa()), "cfo_gt_ni": gt(t.ncfo, t.netinc), "leverage_down": gt(lev(u), lev(t)), "liquidity_up": gt(t.current(), u.current()), "no_issuance": op(lambda x: x <= 0, t.ncfcommon), "margin_up": gt(t.margin(), u.margin()), "turnover_up": gt(t.turnover(), u.turnover())}
    o |= {f"piotroski_{k}": x for k, x in flags.items()}
    o["piotroski_f"] = add(*[op(int, x) for x in flags.values()])
    o["noa_to_assets"] = div(sub(sub(sub(t.assets, t.cashneq), t.investments), sub(t.liabilities, t.debt)), u.assets)
    o |= {"ext_financing_to_assets": div(add(t.ncfcommon, t.ncfdebt), t.assets), "rnd_to_assets": div(t.rnd or 0.0, t.assets), "capex_to_assets": div(neg(t.capex), t.assets)}
    roas = [y.roa() for y in (t, u, v, w)]
    o["roa_variability_3y"] = None if None in roas else stdev(roas)
    o["revenue_growth_variability_3y"] = None if None in yoy else stdev(yoy)
    return o


def test_families_against_plain_formulas(spark):
    rng = random.Random(12)
    names = [n + s for n in LEVELS + FLOWS for s in ("", "_t1", "_t2", "_t3")] + ["marketcap", "ev"]
    rows = []
    for i in range(60):
        null, bad = (0.0, 0.0) if i < 10 else (0.03, 0.1)
        rows.append({n: None if rng.random() < null else -rng.uniform(0, 9) if rng.random() < bad else 0.0 if rng.random() < bad / 3 else rng.uniform(1, 900) for n in names})
    df = spark.createDataFrame([(i, *[r[n] for n in names]) for i, r in enumerate(rows)], "i int, " + ", ".join(f"{n} double" for n in names))
    want = [expected(r) for r in rows]
    known = 0
    for f in FAMILIES:
        for got in family(df, f, ["i"]).collect():
            for c in FAMILIES[f]:
                w = want[got.i][c]
                assert (got[c] is None) == (w is None), (c, rows[got.i])
                if w is not None:
                    known += 1
                    assert got[c] == pytest.approx(w, rel=1e-9, abs=1e-12), c
    assert set(want[0]) == {c for f in FAMILIES.values() for c in f} <= set(columns()) and known > 2000
