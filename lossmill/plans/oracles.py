"""DuckDB SQL for the registered queries, on the same tables."""

from __future__ import annotations

from ..operators.audit import BLOCK_ROWS, REPEATS, SEED, draws
from ..params import NUMERIC_FACTORS, RATING_FACTORS
from .catalog import AUDIT_LIMITS, SAMPLE_MONTH, SAMPLE_REGION
from .regression_sql import coefficient_table


def _settle(value: str, digits: int) -> str:
    return f"CAST(ROUND(CAST({value} AS DECIMAL(38,10)), {digits}) AS DOUBLE)"


BASE = f"""
WITH claims AS (
    SELECT l_orderkey AS IDpol, l_extendedprice * l_discount AS ClaimAmount,
           CAST(l_shipdate AS DATE) AS ClaimDate
    FROM lineitem WHERE l_returnflag = 'R' AND l_linestatus = 'F'
), totals AS (
    SELECT IDpol, SUM(ClaimAmount) AS Amount, COUNT(ClaimAmount) AS N,
           MIN(ClaimDate) AS FirstClaim, MAX(ClaimDate) AS LastClaim
    FROM claims GROUP BY IDpol
), register AS (
    SELECT o_orderkey AS IDpol,
           CAST(o_orderkey % 13 AS DOUBLE) / CAST(12 AS DOUBLE) AS Exposure,
           substr(o_orderpriority, 1, 1) AS Area,
           4 + o_custkey % 12 AS VehPower,
           CAST(floor(o_totalprice / 25000) AS BIGINT) AS VehAge,
           18 + (o_custkey * 7 + o_orderkey) % 70 AS DrivAge,
           50 + o_orderkey % 101 AS BonusMalus,
           c_mktsegment AS VehBrand, o_orderstatus AS VehGas,
           CAST(floor(abs(c_acctbal)) AS BIGINT) AS Density,
           n_name AS Region, CAST(o_orderdate AS DATE) AS Underwriting_Date
    FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
), policy AS (
    SELECT r.IDpol, Exposure, Area, VehPower, VehAge, DrivAge, BonusMalus, VehBrand, VehGas,
           Density, Region, COALESCE(t.N, 0) AS ReportedClaimCount,
           {_settle('COALESCE(t.Amount, CAST(0 AS DOUBLE))', 2)} AS TotalClaimAmount,
           COALESCE(t.N, 0) AS PaidClaimCount, Underwriting_Date,
           CAST(CASE WHEN FirstClaim IS NOT NULL
                THEN GREATEST(date_diff('day', Underwriting_Date, FirstClaim), 0) END AS DOUBLE)
               AS ReportingDelay,
           CAST(date_diff('day', FirstClaim, LastClaim) AS DOUBLE) AS PaymentDelay
    FROM register r LEFT JOIN totals t ON r.IDpol = t.IDpol
), delays AS (
    SELECT IDpol, TotalClaimAmount, ReportingDelay AS ReportingDelayDays,
           PaymentDelay AS PaymentDelayDays
    FROM policy WHERE TotalClaimAmount > 0
), delayed AS (
    SELECT *, ReportingDelayDays + PaymentDelayDays AS TotalDelayDays FROM delays
), staged AS (
    SELECT *, CASE WHEN ReportingDelayDays > 90 THEN 'IBNR'
                   WHEN TotalDelayDays > 90 THEN 'Reported_Open'
                   ELSE 'Paid_Closed' END AS Status FROM delayed
), reserve AS (
    SELECT *,
           CASE WHEN Status = 'Paid_Closed' THEN TotalClaimAmount ELSE 0 END AS PaidAmount,
           CASE WHEN Status = 'Reported_Open' THEN TotalClaimAmount ELSE 0 END AS CaseReserve,
           CASE WHEN Status = 'IBNR' THEN TotalClaimAmount ELSE 0 END AS IBNRReserve,
           TotalClaimAmount AS UltimateLoss
    FROM staged
), priced AS (
    SELECT p.IDpol, p.Exposure, p.Region,
           COALESCE(c.PaidAmount, 0.0) AS PaidLosses,
           COALESCE(c.CaseReserve, 0.0) AS CaseReserves,
           COALESCE(c.IBNRReserve, 0.0) AS IBNRReserves,
           p.TotalClaimAmount + COALESCE(c.IBNRReserve, 0.0) AS UltimateLosses,
           (250.0 + p.VehPower * 15.0 - CASE WHEN p.DrivAge > 25 THEN 50 ELSE 0 END
            + p.BonusMalus * 2.5) * p.Exposure AS EarnedPremium,
           (30.0 + p.TotalClaimAmount * 0.05) * p.Exposure AS UnderwritingExpenses
    FROM policy p LEFT JOIN reserve c ON p.IDpol = c.IDpol
), mart AS (
    SELECT IDpol, Exposure, Region, EarnedPremium, PaidLosses, CaseReserves, IBNRReserves,
           UltimateLosses, UnderwritingExpenses,
           ROUND(UltimateLosses / NULLIF(EarnedPremium, 0) * 100, 2) AS LossRatio,
           ROUND(UnderwritingExpenses / NULLIF(EarnedPremium, 0) * 100, 2) AS ExpenseRatio,
           ROUND((UltimateLosses + UnderwritingExpenses) / NULLIF(EarnedPremium, 0) * 100, 2)
               AS CombinedRatio,
           ROUND(EarnedPremium * 0.5, 2) AS ReinsurerCededPremium,
           ROUND(UltimateLosses * 0.5, 2) AS ReinsurerCededLosses,
           ROUND(UnderwritingExpenses * 0.15, 2) AS ReinsuranceCedingCommission
    FROM priced
), dimension AS (
    SELECT IDpol, Exposure, Region, Area, VehPower, VehAge, DrivAge, BonusMalus,
           ROUND(ReportedClaimCount / NULLIF(Exposure, 0.0), 4) AS Claim_Frequency,
           Underwriting_Date, strftime(Underwriting_Date, '%Y-%m') AS Underwriting_Month
    FROM policy
), monthly AS (
    SELECT d.Underwriting_Month, d.Region,
           SUM(f.EarnedPremium) AS Total_EarnedPremium,
           SUM(f.UltimateLosses) AS Total_UltimateLosses,
           ROUND({_settle('SUM(f.UltimateLosses)', 4)}
                 / NULLIF({_settle('SUM(f.EarnedPremium)', 4)}, 0) * 100, 2) AS Monthly_LR
    FROM dimension d JOIN mart f ON d.IDpol = f.IDpol GROUP BY d.Underwriting_Month, d.Region
), summary AS (
    SELECT Underwriting_Month, Region, Total_EarnedPremium, Total_UltimateLosses, Monthly_LR,
           LAG(Monthly_LR) OVER w AS Prev_Month_LR,
           ROUND(Monthly_LR - LAG(Monthly_LR) OVER w, 2) AS Delta_LR
    FROM monthly WINDOW w AS (PARTITION BY Region ORDER BY Underwriting_Month)
), model AS (
    SELECT d.IDpol, d.Exposure, d.Area, d.VehPower, d.VehAge, d.DrivAge, d.BonusMalus, d.Region,
           p.ReportedClaimCount, f.UltimateLosses, f.EarnedPremium
    FROM dimension d JOIN mart f ON d.IDpol = f.IDpol JOIN policy p ON d.IDpol = p.IDpol
    WHERE d.Exposure > 0
), severe AS (
    SELECT *, UltimateLosses / ReportedClaimCount AS Avg_Severity
    FROM model WHERE ReportedClaimCount > 0
), retention AS (
    SELECT quantile_cont(Avg_Severity, 0.95) AS q FROM severe WHERE UltimateLosses > 0
), capped AS (
    SELECT *, LEAST(Avg_Severity, (SELECT quantile_cont(Avg_Severity, 0.99) FROM severe)) AS Capped
    FROM severe
), flagged AS (
    SELECT IDpol, CAST(CASE WHEN ReportedClaimCount > 0
           AND UltimateLosses / NULLIF(ReportedClaimCount, 0) > (SELECT q FROM retention)
           THEN 1 ELSE 0 END AS BIGINT) AS Is_Large_Loss FROM model
)
"""

MONTHS = f"""
SELECT Underwriting_Month, Region, {_settle('Total_EarnedPremium', 2)} AS Total_EarnedPremium,
       {_settle('Total_UltimateLosses', 2)} AS Total_UltimateLosses,
       Monthly_LR, Prev_Month_LR, Delta_LR
FROM summary"""

MODEL = f"SELECT *, {_settle('ln(Exposure)', 8)} AS Log_Exposure FROM model"

AREAS = ("5", "4", "3", "2")
TERMS = [*NUMERIC_FACTORS, *(f"Area_{a}" for a in AREAS), "Intercept"]
DESIGN = "[" + ", ".join([*NUMERIC_FACTORS, *(f"CAST(Area = '{a}' AS INT)" for a in AREAS), "1"]) + "]::DOUBLE[] AS x"

#: The order of the donors, and what every policy gets in each repeat.
DONORS = f"""
, audited AS (
    SELECT d.IDpol, d.Area, d.VehPower, d.Region, p.ReportedClaimCount AS y
    FROM dimension d JOIN policy p ON d.IDpol = p.IDpol WHERE d.Exposure > 0
), shuffled AS (
    SELECT *, md5('{SEED}:' || IDpol) AS o,
           CAST('0x' || substr(md5('{SEED}:' || IDpol), 1, 8) AS BIGINT)
               % greatest(1, (SELECT count(*) FROM audited) // {BLOCK_ROWS}) AS block
    FROM audited
), placed AS MATERIALIZED (
    SELECT *, row_number() OVER (PARTITION BY block ORDER BY o, IDpol) - 1 AS place,
           count(*) OVER (PARTITION BY block) AS m
    FROM shuffled
), shifts AS (
    SELECT unnest(range(1, {REPEATS + 1})) AS r, unnest({draws(REPEATS, SEED)!r}) AS share
), donated AS MATERIALIZED (
    SELECT a.IDpol, a.y, a.Area, a.VehPower, a.Region, s.r,
           b.Area AS Area_d, b.VehPower AS VehPower_d, b.Region AS Region_d
    FROM placed a CROSS JOIN shifts s JOIN placed b ON a.block = b.block
     AND b.place = ((a.place - 1 - CAST(floor(s.share * (a.m - 1)) AS BIGINT)) % a.m + a.m) % a.m
)"""

RATES = """
, of_area AS (SELECT Area, ln(avg(y) / (SELECT avg(y) FROM audited)) AS e FROM audited GROUP BY Area
), of_region AS (SELECT Region, ln(avg(y) / (SELECT avg(y) FROM audited)) AS e FROM audited GROUP BY Region
), of_power AS (SELECT VehPower > 9 AS strong, ln(avg(y) / (SELECT avg(y) FROM audited)) AS e FROM audited GROUP BY strong
), effects AS MATERIALIZED (
    SELECT t.r, t.y, (SELECT ln(avg(y)) FROM audited) AS base,
           a.e AS Area, r.e AS Region, p.e AS VehPower, ad.e AS Area_d, rd.e AS Region_d, pd.e AS VehPower_d
    FROM donated t
    JOIN of_area a ON t.Area = a.Area JOIN of_area ad ON t.Area_d = ad.Area
    JOIN of_region r ON t.Region = r.Region JOIN of_region rd ON t.Region_d = rd.Region
    JOIN of_power p ON (t.VehPower > 9) = p.strong JOIN of_power pd ON (t.VehPower_d > 9) = pd.strong
), rises AS (
    SELECT Feature, r, 2 * sum(exp(after) - y * after - exp(before) + y * before) / count(*) AS importance
    FROM (
        SELECT r, y, base + Area + Region + VehPower AS before,
               unnest([{features}]) AS Feature,
               unnest([{after}]) AS after
        FROM effects
    ) GROUP BY Feature, r
)""".format(
    features=", ".join(f"'{name}'" for name in RATING_FACTORS),
    after=", ".join(
        "base + " + " + ".join(f"{n}_d" if n == name else n for n in ("Area", "Region", "VehPower")) for name in RATING_FACTORS
    ),
)

SELECTS = {
    "glm_frequency": ", "
    + coefficient_table(f"SELECT {DESIGN}, ReportedClaimCount AS y, Exposure AS e FROM model", TERMS, False, _settle),
    "glm_severity": ", " + coefficient_table(f"SELECT {DESIGN}, Capped AS y, 1.0 AS e FROM capped WHERE Capped > 0", TERMS, True, _settle),
    "glm_severity_moments": "SELECT "
    + ", ".join(f"CAST(SUM({name}) AS DOUBLE) AS Sum_{name}" for name in NUMERIC_FACTORS)
    + " FROM capped WHERE Capped > 0",
    "permutation_donors": DONORS
    + " SELECT IDpol, y AS claims, any_value(Region) AS Region_0, "
    + ", ".join(f"max(Region_d) FILTER (r = {r}) AS Region_{r}" for r in range(1, REPEATS + 1))
    + " FROM donated GROUP BY IDpol, y",
    "permutation_importance_rates": DONORS
    + RATES
    + " SELECT Feature, "
    + ", ".join(
        f"{_settle(value, 8)} AS {name}"
        for name, value in {
            "Mean_Importance": "avg(importance)",
            "Std_Importance": "stddev_pop(importance)",
            "Min_Importance": "min(importance)",
            "Q1_Importance": "quantile_cont(importance, 0.25)",
            "Median_Importance": "quantile_cont(importance, 0.5)",
            "Q3_Importance": "quantile_cont(importance, 0.75)",
            "Max_Importance": "max(importance)",
        }.items()
    )
    + " FROM rises GROUP BY Feature",
    "claims_per_policy": f"""
        SELECT IDpol, {_settle('Amount', 4)} AS TotalClaimAmount, N AS ActualClaimCount,
               FirstClaim, LastClaim
        FROM totals""",
    "policy_portfolio": "SELECT * FROM policy",
    "portfolio_validation": """
        SELECT COUNT(*) AS Total_Policies,
               COUNT(*) FILTER (TotalClaimAmount = 0) AS Zero_Claim_Policies,
               COUNT(*) FILTER (TotalClaimAmount > 0) AS Claim_Bearing_Policies FROM policy""",
    "key_uniqueness": """
        SELECT CAST(SUM(n) AS BIGINT) AS Total_Policies, COUNT(*) AS Distinct_Keys,
               MAX(n) AS Most_Rows_Per_Key
        FROM (SELECT IDpol, COUNT(*) AS n FROM register GROUP BY IDpol)""",
    "scan_csv_tolerant": """
        SELECT o_orderkey AS IDpol,
               CASE WHEN o_orderkey % 11 <> 5 AND o_orderkey % 17 = 8 THEN NULL
                    ELSE o_totalprice END AS Amount,
               CASE WHEN o_orderkey % 11 = 5 THEN NULL
                    WHEN o_orderkey % 17 = 8 THEN substr(o_orderpriority, 1, 1)
                    WHEN o_orderkey % 19 = 9
                    THEN substr(o_orderpriority, 1, 1) || chr(10) || substr(o_orderpriority, 1, 1)
                    ELSE substr(o_orderpriority, 1, 1) || ',x' END AS Area
        FROM orders
        WHERE o_orderkey % 7 <> 3 AND (o_orderkey % 11 = 5 OR o_orderkey % 13 <> 6)""",
    "scan_csv_auto": """
        SELECT o_orderkey, o_custkey, o_totalprice, o_orderpriority FROM orders
        WHERE o_orderkey % 997 <> 5""",
    "mart_roundtrip": "SELECT * FROM mart",
    "export_parquet_zstd": MONTHS,
    "claim_delays": """
        SELECT IDpol, TotalClaimAmount, ReportingDelayDays, PaymentDelayDays, TotalDelayDays
        FROM delayed""",
    "claims_reserving": """
        SELECT IDpol, TotalClaimAmount, ReportingDelayDays, PaymentDelayDays, TotalDelayDays,
               Status, PaidAmount, CaseReserve, IBNRReserve, UltimateLoss FROM reserve""",
    "reserve_totals": f"""
        SELECT {_settle('SUM(PaidAmount)', 2)} AS Total_Paid,
               {_settle('SUM(CaseReserve)', 2)} AS Total_Case,
               {_settle('SUM(IBNRReserve)', 2)} AS Total_IBNR FROM reserve""",
    "earned_premium": "SELECT IDpol, EarnedPremium FROM mart",
    "financial_mart": "SELECT * FROM mart",
    "financial_mart_rowwise": "SELECT * FROM mart",
    "quota_share": """
        SELECT IDpol, ReinsurerCededPremium, ReinsurerCededLosses, ReinsuranceCedingCommission
        FROM mart""",
    "portfolio_ratios": f"""
        SELECT ROUND(losses / NULLIF(premium, 0) * 100, 2) AS Portfolio_Loss_Ratio,
               ROUND(cost / NULLIF(premium, 0) * 100, 2) AS Portfolio_Expense_Ratio,
               ROUND(together / NULLIF(premium, 0) * 100, 2) AS Portfolio_Combined_Ratio
        FROM (SELECT {_settle('SUM(UltimateLosses)', 4)} AS losses,
                     {_settle('SUM(UnderwritingExpenses)', 4)} AS cost,
                     {_settle('SUM(UltimateLosses + UnderwritingExpenses)', 4)} AS together,
                     {_settle('SUM(EarnedPremium)', 4)} AS premium FROM mart)""",
    "dim_policies": "SELECT * FROM dimension",
    "underwriting_date": """
        SELECT IDpol, Underwriting_Date, strftime(Underwriting_Date, '%Y-%m') AS Underwriting_Month
        FROM (SELECT o_orderkey AS IDpol, CAST(o_orderdate AS DATE) AS Underwriting_Date FROM orders)""",
    "fact_financials": "SELECT * FROM mart",
    "monthly_regional_summary": MONTHS,
    "monthly_regional_summary_star": MONTHS,
    "region_month_sample": f"""
        SELECT Region, Underwriting_Month, Monthly_LR, Delta_LR FROM summary
        WHERE Region = '{SAMPLE_REGION}' AND Underwriting_Month >= '{SAMPLE_MONTH}'
        ORDER BY Underwriting_Month LIMIT 3""",
    "modeling_dataset": MODEL,
    "modeling_dataset_rowwise": MODEL,
    "audit_dataset": """
        SELECT d.IDpol, d.Area, d.VehPower, d.VehAge, d.DrivAge, d.BonusMalus, d.Region,
               p.ReportedClaimCount
        FROM dimension d JOIN policy p ON d.IDpol = p.IDpol WHERE d.Exposure > 0""",
    "severity_dataset": """
        SELECT IDpol, ReportedClaimCount, UltimateLosses, Avg_Severity
        FROM severe WHERE UltimateLosses > 0""",
    "severity_capped": f"SELECT IDpol, {_settle('Capped', 6)} AS Avg_Severity FROM capped",
    "xol_threshold": f"SELECT {_settle('q', 6)} AS Retention FROM retention",
    "large_loss_flag": "SELECT IDpol, Is_Large_Loss FROM flagged",
    "class_balance": """
        SELECT COUNT(*) AS Policies, CAST(SUM(Is_Large_Loss) AS BIGINT) AS Large_Losses,
               CAST(COUNT(*) - SUM(Is_Large_Loss) AS DOUBLE) / NULLIF(SUM(Is_Large_Loss), 0)
                   AS Class_Ratio FROM flagged""",
    "poisson_deviance": f"""
        SELECT {_settle('''AVG(2 * (CASE WHEN y > 0 THEN y * ln(y / mu) ELSE 0 END - (y - mu)))''', 8)}
                   AS Mean_Poisson_Deviance
        FROM (SELECT m.ReportedClaimCount AS y, m.Exposure * r.Frequency AS mu
              FROM model m JOIN (SELECT Region, SUM(ReportedClaimCount) / SUM(Exposure) AS Frequency
                                 FROM model GROUP BY Region) r ON m.Region = r.Region)""",
    "glm_frequency_balance": f"""
        SELECT Area, {_settle('SUM(ReportedClaimCount)', 2)} AS Claims
        FROM model GROUP BY Area""",
    "glm_frequency_moments": "SELECT "
    + ", ".join(
        f"CAST(SUM(ReportedClaimCount * {name}) AS DOUBLE) AS Claims_By_{name}"
        for name in NUMERIC_FACTORS
    )
    + " FROM model",
    "glm_severity_balance": """
        SELECT Area, CAST(COUNT(*) AS DOUBLE) AS Policies FROM capped WHERE Capped > 0
        GROUP BY Area""",
    "pure_premium_observed": """
        SELECT IDpol, ReportedClaimCount * s AS Expected_Pure_Premium,
               ReportedClaimCount * s / NULLIF(EarnedPremium, 0) * 100 AS Technical_Loss_Ratio
        FROM (SELECT *, COALESCE(UltimateLosses / NULLIF(ReportedClaimCount, 0), 0) AS s
              FROM model)""",
    "leakage_clusters": f"""
        SELECT d.Region, d.VehPower, ROUND({_settle('AVG(m.TLR)', 6)}, 2) AS Avg_TLR,
               COUNT(*) AS Toxic_Policy_Count, ROUND({_settle('SUM(m.EPP)', 4)}, 2) AS Total_Expected_Losses
        FROM (SELECT p.IDpol, p.TotalClaimAmount AS EPP,
                     p.TotalClaimAmount / NULLIF(f.EarnedPremium, 0) * 100 AS TLR
              FROM policy p JOIN mart f ON p.IDpol = f.IDpol WHERE p.Exposure > 0) m
        JOIN dimension d ON m.IDpol = d.IDpol
        WHERE m.TLR > {AUDIT_LIMITS.ratio_above}
        GROUP BY d.Region, d.VehPower HAVING COUNT(*) > {AUDIT_LIMITS.policies_above}
        ORDER BY Avg_TLR DESC NULLS LAST, d.Region, d.VehPower LIMIT {AUDIT_LIMITS.top}""",
}


def oracle_sql() -> dict[str, str]:
    base = BASE.replace("WITH", "WITH RECURSIVE", 1)
    return {name: base + select for name, select in SELECTS.items()}
