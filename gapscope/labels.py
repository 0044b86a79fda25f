"""Fixed values that must equal the source pipeline's for right results.

Fixed values (measure labels, raw column labels, keywords, constants):
everything below is stated as the source data uses it; do not edit.
"""

from __future__ import annotations

# --- fixed values: measure labels in the long-form tax facts ---------------
PROFIT_MEASURE = "Profit (loss) before income tax"
TAX_PAID_MEASURE = "Income tax paid (on cash basis)"
EMPLOYEES_MEASURE = "Employees"
MNE_GROUPS_MEASURE = "Multinational enterprise groups"
STATUTORY_MEASURE = "Corporate income tax rate"

# pivoted column name for each measure label (in this order)
PIVOT_COLUMNS = {
    PROFIT_MEASURE: "profit_before_tax",
    TAX_PAID_MEASURE: "tax_paid",
    EMPLOYEES_MEASURE: "employees",
    MNE_GROUPS_MEASURE: "mne_group_count",
}

# --- fixed values: raw CSV labels and their clean names --------------------
FACT_COLUMNS = {
    "Reference area": "jurisdiction",
    "Counterpart area": "counterpart_jurisdiction",
    "Measure": "measure",
    "TIME_PERIOD": "year",
    "OBS_VALUE": "obs_value",
}
FACT_KEYS = ["jurisdiction", "counterpart_jurisdiction", "measure", "year"]
FACT_NOT_NULL = ["jurisdiction", "year", "obs_value"]

RATE_COLUMNS = {
    "Reference area": "jurisdiction",
    "Measure": "measure",
    "TIME_PERIOD": "year",
    "OBS_VALUE": "tax_rate",
}
RATE_KEYS = ["jurisdiction", "measure", "year"]
RATE_NOT_NULL = ["jurisdiction", "year", "tax_rate"]

# --- fixed values: JSON-stat ratio filters ---------------------------------
TAX_CATEGORY_KEYWORDS = ["Total receipts from taxes"]
UNIT_OF_MEASURE_KEYWORDS = ["Percentage of gross domestic product"]

# --- our own wording ----------------------------------------------------------
MISSING_COLUMNS_MESSAGE = "The landing lacks the columns {missing}; it has {available}"
GAP_FLAG_REASON = "statutory rate exceeds the effective rate by over five points"

# --- fixed values: constants ----------------------------------------------
LOOKBACK_DAYS = 7
FIRST_PERIOD = 2016
GAP_FLAG_THRESHOLD = 5.0
FLAG_STATUS_OPEN = "OPEN"
