"""Fixed values.

These must stay equal to the values of the analysed scripts for equal results:
value maps, regular expressions, column-name sets and fill constants.  They are
listed plainly, in their natural order.
"""

# --- fixed values: text patterns -------------------------------------------------
# "13.56%" (optionally preceded by blanks) -> "13.56"
PERCENT_PATTERN = r"\s{0,}(\d{1,}\.?\d{0,})\%"
# "Aug-2003" -> "2003"
YEAR_PATTERN = r"\w+\-(\d{4})"

# --- fixed values: value maps -------------------------------------------------------
EMPLOYMENT_LENGTH = {
    "< 1 year": 0,
    "1 year": 1,
    "2 years": 2,
    "3 years": 3,
    "4 years": 4,
    "5 years": 5,
    "6 years": 6,
    "7 years": 7,
    "8 years": 8,
    "9 years": 9,
    "10+ years": 10,
}

HOME_OWNERSHIP = {
    "MORTGAGE": "MORTGAGE",
    "RENT": "RENT",
    "OWN": "OWN",
    "OTHER": "OTHER",
    "ANY": "OTHER",
    "NONE": "OTHER",
}

LOAN_STATUS_LABEL = {"Fully Paid": 0, "Charged Off": 1}

# --- fixed values: fill constants of the newer table ---------------------------------
TABLE_B_FILLS = {
    "CreditScoreEsMicroL": "Other",
    "Rating": "Other",
    "HomeOwnershipType": "Not_specified",
    "EmploymentDurationCurrentEmployer": "Other",
    "EmploymentStatus": "Not_specified",
    "OccupationArea": "Not_specified",
    "VerificationType": "Not_set",
    "Education": "Not_present",
    "Gender": "Unknown",
    "MaritalStatus": "Not_specified",
}

# --- fixed values: feature-name sets of the older table ------------------------------
FEATURE_SET_1 = {
    "addr_state", "annual_inc", "application_type", "dti", "emp_length",
    "fico_range_high", "fico_range_low", "grade", "home_ownership",
    "initial_list_status", "installment", "int_rate", "loan_amnt",
    "loan_status", "mort_acc", "open_acc", "pub_rec",
    "pub_rec_bankruptcies", "purpose", "revol_bal", "revol_util",
    "sub_grade", "term", "title", "total_acc", "verification_status",
}
FEATURE_SET_2 = {
    "acc_now_delinq", "annual_inc", "delinq_2yrs", "dti", "emp_length",
    "fico_range_high", "fico_range_low", "home_ownership", "il_util",
    "installment", "int_rate", "loan_amnt", "loan_status",
    "max_bal_bc", "mths_since_last_major_derog", "num_accts_ever_120_pd",
    "num_actv_rev_tl", "num_rev_accts", "num_sats", "num_tl_90g_dpd_24m",
    "open_act_il", "pct_tl_nvr_dlq", "pub_rec", "pub_rec_bankruptcies",
    "revol_util", "sub_grade", "tax_liens", "tot_coll_amt",
    "hardship_flag", "hardship_status", "hardship_length",
    "debt_settlement_flag",
}
FEATURE_SET_3 = {
    "addr_state", "annual_inc", "application_type", "dti",
    "earliest_cr_line", "emp_length", "emp_title", "fico_range_high",
    "fico_range_low", "grade", "hardship_flag", "home_ownership",
    "id", "initial_list_status", "installment", "int_rate", "issue_d",
    "loan_amnt", "loan_status", "mort_acc", "open_acc", "pub_rec",
    "pub_rec_bankruptcies", "purpose", "revol_bal", "revol_util",
    "sub_grade", "tax_liens", "term", "title", "total_acc",
    "verification_status",
}
FEATURE_SET_4 = {
    "acc_now_delinq", "acc_open_past_24mths", "addr_state",
    "annual_inc", "all_util", "bc_util", "revol_util", "dti",
    "emp_length", "emp_title", "fico_range_high", "fico_range_low",
    "home_ownership", "inq_last_12m", "int_rate", "loan_amnt",
    "mort_acc", "mths_since_recent_inq", "num_accts_ever_120_pd",
    "num_tl_30dpd", "num_tl_90g_dpd_24m", "num_tl_op_past_12m",
    "open_acc_6m", "open_il_24m", "open_rv_24m", "percent_bc_gt_75",
    "pub_rec", "pub_rec_bankruptcies", "term", "total_acc",
    "verification_status", "loan_status",
}
FEATURE_SETS_REMOVED = {
    "hardship_status", "hardship_length", "tot_coll_amt",
    "mths_since_last_major_derog", "id", "grade", "emp_title",
    "issue_d", "title", "debt_settlement_flag", "hardship_flag",
}

# --- fixed values: library defaults the scripts rely on ------------------------------
IMBALANCED_REPORT_ALPHA = 0.1      # index of balanced accuracy weight
HALVING_FACTOR = 3                 # successive-halving reduction factor
SPLIT_SEED = 111                   # the scripts' random_state
