"""Layouts of the extracts and of the tables made from them.

Fixed values: headers, column order and types are those of the source files.
"""

from __future__ import annotations

from tallyloom.contracts import contract, ordered

# Read by position.
PERSONS = ordered(
    "person_id string, source_id string, name string, sex string, dob date, address string, "
    "city string, state string, zip string, phone string, email string, pcp string"
)
ALLERGIES = contract(string="source_id allergen_key name reaction type severity")
PROBLEMS = contract(string="source_id diagnosis icd start_date end_date status is_cancer")
PORTAL = contract(string="source_id mychart_status mychart_activation_date")
ENCOUNTERS = ordered(
    "source_id string, name string, sex string, dob string, address string, city string, "
    "state string, zip string, phone string, email string, pcp string, dept string, "
    "encounter_date string, encounter_time string, encounter_type string, "
    "service_provider string, with_pcp int, appt_status string, diagnoses string, "
    "diagnoses_icd string, level_of_service string, level_of_service_name string"
)
MISC_VOLUMES = contract(string="month metric", bigint="volume")
AGED_AR = contract(string="date aged_days", double="total", bigint="num_accts")

# Read by header, with the name each column gets.
ED_ENCOUNTERS = ordered(
    "PrimaryMRN string, ArrivalInstant timestamp, DepartureInstant timestamp, "
    "ChiefComplaint string, Diagnosis string, Age int, FirstAttending string, LastAttending string"
)
ED_NAMES = {
    "PrimaryMRN": "source_id",
    "ArrivalInstant": "arrival_at",
    "DepartureInstant": "departure_at",
    "ChiefComplaint": "chief_complaint",
    "Diagnosis": "diagnosis",
    "Age": "encounter_age",
    "FirstAttending": "first_attending",
    "LastAttending": "last_attending",
}
INPATIENT = contract(string="PrimaryMRN AdmissionDate DischargeDate Diagnosis Department")
INPATIENT_NAMES = {
    "PrimaryMRN": "source_id",
    "AdmissionDate": "admission_key",
    "DischargeDate": "discharge_key",
    "Diagnosis": "diagnosis",
    "Department": "dept",
}
NOTES = ordered(
    "mrn string, name string, dept string, note_type string, primary_diag string, "
    "author_name string, author_type string, author_service string, first_author_name string, "
    "cosigner_name string, service_dt timestamp, dob timestamp"
)
NOTES_NAMES = {
    "mrn": "source_id",
    "service_dt": "service_date",
    "primary_diag": "diagnosis",
    "author_service": "service",
}
IMAGING = ordered(
    "ImagingKey bigint, DepartmentName string, ScheduledExamDateKey bigint, "
    "ExamEndDateKey bigint, Modality string, StudyStatus string"
)
IMAGING_NAMES = {
    "ImagingKey": "imaging_key",
    "DepartmentName": "dept",
    "ScheduledExamDateKey": "scheduled_key",
    "ExamEndDateKey": "service_key",
    "Modality": "modality",
    "StudyStatus": "study_status",
}
CHARGES = ordered(
    "BillingTransactionKey bigint, PrimaryMRN string, EncounterCSN string, "
    "ServiceDateKey bigint, PostDateKey bigint, BillingProviderName string, "
    "PostingUserName string, BillingProcedureCode string, ModifierCodes string, "
    "BillingProcedureQuantity bigint, BillingProcedureDescription string, RevenueCode string, "
    "RevenueCodeName string, RvuWork double, RvuTotal double, ReversalReason string, "
    "ChargeAmount double, IsInactive boolean, PrimaryPayorClass string, CostCenterName string, "
    "PlaceOfServiceName string"
)
CHARGES_NAMES = {
    "BillingTransactionKey": "id",
    "PrimaryMRN": "source_id",
    "EncounterCSN": "encounter_csn",
    "ServiceDateKey": "service_key",
    "PostDateKey": "post_key",
    "BillingProviderName": "billing_provider",
    "PostingUserName": "posting_user",
    "BillingProcedureCode": "procedure_code",
    "ModifierCodes": "modifiers",
    "BillingProcedureQuantity": "quantity",
    "BillingProcedureDescription": "procedure_desc",
    "RevenueCode": "rev_code",
    "RevenueCodeName": "rev_code_desc",
    "RvuWork": "wrvu",
    "RvuTotal": "trvu",
    "ReversalReason": "reversal_reason",
    "ChargeAmount": "charge_amount",
    "IsInactive": "is_inactive",
    "PrimaryPayorClass": "primary_payor_class",
    "CostCenterName": "dept",
    "PlaceOfServiceName": "location",
}

# Fee tables: lines to skip, fields per line, ordinals kept.
FEE_SKIP = 10
FEE_WIDTH = 32
FEE_MAIN = {0: "hcpcs", 5: "wrvu", 11: "nonfacility_trvu", 12: "facility_trvu"}
FEE_SUPPLEMENT = {
    0: "hcpcs", 3: "status_code", 5: "wrvu", 11: "nonfacility_trvu", 31: "facility_trvu",
}
FEES = contract(string="hcpcs", double="wrvu nonfacility_trvu facility_trvu")
FEES_SUPPLEMENT = contract(string="hcpcs status_code", double="wrvu nonfacility_trvu facility_trvu")

# Tables written.
ID_MAP = contract(string="person_id source_id", date="dob")
VOLUMES = ordered(
    "dept_id string, dept_name string, month string, volume double, unit string"
)
BUDGET = ordered(
    "dept_id string, dept_name string, year int, budget_fte double, budget_prod_hrs double, "
    "budget_contracted_hours double, budget_volume double, budget_uos double, "
    "budget_prod_hrs_per_uos double, hourly_rate double"
)
CONTRACTED = contract(
    string="name type dept_name dept_id month",
    double="reg_hrs overtime_hrs call_hrs holiday_hrs callback_hrs other_hrs total_hrs",
)
INCOME = contract(
    string="month ledger_acct dept_id dept_name spend_category revenue_category",
    double="actual budget actual_ytd budget_ytd",
)
PERIOD_HOURS = contract(
    string="pay_period dept_id dept_name",
    double="reg_hrs overtime_hrs prod_hrs nonprod_hrs total_hrs total_amt total_fte",
    date="start_date",
)
BALANCE = ordered(
    "month string, tree string, line_num bigint, ledger_acct string, actual double, "
    "actual_prev_month double, actual_prev_year double"
)
