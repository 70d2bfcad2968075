"""Metric columns of the partner reports."""

# Columns of the four pre-aggregated metric tables, in report order.
USAGE_FIELDS = """
    count_active_users
    count_newly_created_accounts
    count_existing_accounts
    count_newly_proofed_users
    count_preverified_users
    count_authentications
""".split()

OUTCOME_TOTALS = """
    count_pass_sum
    count_newly_verified_sum
    count_deadend_sum
    count_friction_sum
    count_abandon_sum
    count_fraud_sum
""".split()

OUTCOME_DETAILS = """
    count_inauthentic_doc
    count_facial_mismatch
    count_invalid_attributes_dl_dos
    count_ssn_dob_deceased
    count_address_other_not_found
    count_pending_lg99_likely_fraud
    count_stayed_blocked
    count_fraud_alert
    count_suspicious_phone
    count_lack_phone_ownership
    count_wrong_phone_type
    count_blocked_by_ipp_fraud
    count_pass_via_lg99
    count_pass_online_finalization
    count_pass_ipp_online_portion
    count_pass_via_letter
    count_doc_auth_ux
    count_selfie_ux
    count_dob_incorrect
    count_ssn_incorrect
    count_identity_not_found
    count_friction_during_otp
    count_doc_auth_technical_issue
    count_resolution_technical_issues
    count_doc_auth_processing_issue
""".split()

AUTH_FIELDS = """
    count_auth_successful
    count_auth_failure
    count_desktop_successful
    count_mobile_successful
    count_webauthn_platform_successful
    count_totp_successful
    count_piv_cac_successful
    count_sms_successful
    count_voice_successful
    count_backup_code_successful
    count_webauthn_successful
    count_personal_key_successful
""".split()

ACCOUNT_FIELDS = """
    count_creation_successful
    count_creation_failed
    count_registered_blocked_fraud
""".split()

# Metric table per kind, with the name of its provider column.
METRIC_TABLES = {
    "usage": ("sp_usage_metrics", "service_provider_id", USAGE_FIELDS),
    "idv": ("sp_idv_outcomes", "start_service_provider_id", OUTCOME_TOTALS + OUTCOME_DETAILS),
    "auth": ("sp_auth_metrics", "service_provider_id", AUTH_FIELDS),
    "account": ("sp_account_creation_metrics", "service_provider_id", ACCOUNT_FIELDS),
}
PERIOD_COLUMNS = {
    "monthly": ("month_start_calendar_id", "month_start_date_actual"),
    "weekly": ("week_start_calendar_id", "week_start_date_actual"),
    "daily": ("calendar_id", "date_actual"),
}
