"""Wide analytics tables, one per subject, and their summary queries."""

from wardflow.plans.marts.claims import mart_claims, summary_claims, topk_claims
from wardflow.plans.marts.doctor import mart_doctor, summary_doctor, topk_doctor
from wardflow.plans.marts.drug import mart_drug, summary_drug, topk_drug
from wardflow.plans.marts.financial import mart_financial, summary_financial, topk_financial
from wardflow.plans.marts.hospital import mart_hospital, summary_hospital, topk_hospital
from wardflow.plans.marts.operational import (
    daily_occupancy,
    lookup_operational,
    mart_operational,
    summary_operational,
    topk_operational,
)
from wardflow.plans.marts.patient import mart_patient, summary_patient

MARTS = {
    "patient_analytics": mart_patient,
    "hospital_performance": mart_hospital,
    "doctor_performance": mart_doctor,
    "claims_analytics": mart_claims,
    "drug_utilization": mart_drug,
    "financial_summary": mart_financial,
    "operational_metrics": mart_operational,
}

__all__ = [name for name in globals() if name.startswith(("mart_", "summary_", "topk_", "lookup_", "daily_"))] + ["MARTS"]
