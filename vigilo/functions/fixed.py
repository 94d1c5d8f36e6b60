"""Fixed values that results depend on. Every operator takes them as a default argument."""

# Incident code -> incident group.
INCIDENT_GROUPS = {
    "SR": "SchoolRule",
    "OF": "Weapon",
    "HG": "Weapon",
    "SG": "Weapon",
    "DW": "Weapon",
    "DG": "Drug",
    "AL": "Drug",
    "AS": "Assault",
    "AE": "Assault",
}

# Incident groups that become flags.
INCIDENT_FLAGS = ("Assault", "Drug", "Weapon", "SchoolRule")

# Removal types that never count.
EXCLUDED_REMOVALS = ("IS", "SP")

# Language levels: upper cut (exclusive) -> label, and the label above the last cut.
LANGUAGE_CUTS = (3, 5, 7)
LANGUAGE_LABELS = ("Low", "Medium", "High", "Native")

# Outcome labels.
ON_TIME = "on-time"
LATE = "Late"
NON_GRAD = "Non-grad"
UNKNOWN_EXIT = "exitWIpublicK12"

# Withdrawal codes of the latest enrolment -> outcome label.
WITHDRAW_OUTCOMES = {
    "DE": UNKNOWN_EXIT,
    "TNC": UNKNOWN_EXIT,
    "TOS": UNKNOWN_EXIT,
    "OOS": UNKNOWN_EXIT,
    "HSC": LATE,
    "PCC": LATE,
}

# Class labels of the training target, larger class first.
CLASS_LABELS = ("Grad", "Non.Grad")

# Offsets of the shifted logarithms.
DAYS_OFFSET = 0.01
COUNT_OFFSET = 0.1

# Attendance: school days per year and upper cuts (inclusive) of days missed.
SCHOOL_DAYS = 180
DAYS_MISSED_CUTS = (12, 20)

# Median standard error above which the squared error is used as the precision.
ERROR_SWITCH = 0.15

# Two-sided normal quantile of the 75% interval.
Z_75 = 1.1503493803760079

# Last year with a known outcome, grade above which every cohort counts alike, lowest grade.
LAST_KNOWN_YEAR = 2013
TOP_GRADE = 8
LOWEST_GRADE = 5

# Split shares (train, valid) by mode.
SPLIT_SHARES = {
    "PROD": (0.45, 0.25),
    "DEV": (0.25, 0.25),
}

# Synthetic minority over-sampling: copies per minority row, neighbours, majority per copy.
SMOTE_COPIES = 2
SMOTE_NEIGHBOURS = 5
SMOTE_MAJORITY_PER_COPY = 2

# Columns of the risk export, in order.
EXPORT_COLUMNS = (
    "X", "WSN", "STUDENT_KEY", "DATE", "MODEL", "MODEL_DATA", "MODEL_NAME",
    "STUDENT_RISK_SEVERITY_SCORE", "STUDENT_RISK_SEVERITY_PRECISION", "STUDENT_RISK_OUTCOME",
    "STUDENT_RISK_MEASURE_VALUE_Att", "STUDENT_RISK_MEASURE_VALUE_Att2",
    "STUDENT_RISK_MEASURE_VALUE_Att3", "STUDENT_RISK_MEASURE_VALUE_Att4",
    "STUDENT_RISK_REPORT_TEXTAtt",
    "STUDENT_RISK_MEASURE_VALUE_Assess1", "STUDENT_RISK_MEASURE_VALUE_Assess2",
    "STUDENT_RISK_MEASURE_VALUE_Assess3", "STUDENT_RISK_MEASURE_VALUE_Assess4",
    "STUDENT_RISK_REPORT_TEXTAssess",
    "STUDENT_RISK_MEASURE_VALUE_Disc", "STUDENT_RISK_MEASURE_VALUE_Disc2",
    "STUDENT_RISK_MEASURE_VALUE_Disc3", "STUDENT_RISK_REPORT_TEXTDisc",
    "STUDENT_RISK_MEASURE_VALUE_Mob", "STUDENT_RISK_MEASURE_VALUE_Mob2",
    "STUDENT_RISK_REPORT_TEXTMob", "GRADE_LEVEL", "SCHOOL_YEAR",
)

# Days until a risk record expires.
RISK_LIFETIME_DAYS = 365
