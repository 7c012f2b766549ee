"""Declared schemas of the source tables and of the control tables."""

from __future__ import annotations

from pyspark.sql.types import StructType

# Names, types and required columns of the tables, which must equal the published data model.
_DDL = {
    "users": """
        user_id string, name string, age int, gender string,
        subscription_start_date date, current_plan_id string, family_id string""",
    "families": """
        family_id string, has_bundle boolean, bundle_type string, has_home_internet boolean,
        internet_product_group string, internet_contract_months int, internet_status string,
        bundle_discount_method string, total_discount_allocation_method string,
        internet_benefit_discount_id string""",
    "bundle_discount_compositions": """
        bundle_composition_id string, family_id string, component_type string, user_id string,
        component_role string, status string, start_date date, end_date date""",
    "plans": """
        plan_id string, plan_name string, plan_family string, plan_category string,
        monthly_fee decimal(12,2), data_limit_gb decimal(10,2), is_unlimited boolean,
        throttle_speed string, voice string, sms string, base_shared_data_gb decimal(10,2),
        is_rollover boolean, membership_tier string, choice_tier string, network_type string,
        device_discount_lines int, data_sharing_discount_lines int,
        family_bundle_eligible boolean""",
    "age_benefits": """
        age_benefit_id string, benefit_name string, min_age decimal(5,1), max_age decimal(5,1),
        includes_safety_box boolean""",
    "plan_age_benefits": """
        plan_age_benefit_id string, plan_id string, age_benefit_id string,
        bonus_data_gb decimal(10,2), bonus_shared_data_gb decimal(10,2),
        bonus_voice_minutes decimal(10,1), bonus_sms_count decimal(10,1),
        bonus_video_minutes decimal(10,1)""",
    "additional_services": """
        service_id string, service_name string, service_category string,
        normal_monthly_price decimal(12,2)""",
    "plan_benefits": """
        plan_benefit_id string, plan_id string, service_id string, benefit_type string,
        benefit_value string, is_selectable boolean, option_group string, selection_count int""",
    "discounts": """
        discount_id string, policy_domain string, benefit_code string, discount_name string""",
    "internet_bundle_discount_rules": """
        internet_bundle_rule_id string, discount_id string, bundle_discount_method string,
        rule_type string, internet_product_group string, contract_months int,
        mobile_total_fee_min decimal(12,2), mobile_total_fee_max decimal(12,2),
        mobile_line_fee_min decimal(12,2), mobile_line_fee_max decimal(12,2),
        discount_target string, allocation_method string, discount_amount decimal(12,2),
        discount_rate decimal(8,5), effective_start_date date, effective_end_date date""",
    "premium_family_discount_rules": """
        premium_family_rule_id string, discount_id string, benefit_type string,
        eligible_component_role string, requires_internet boolean,
        minimum_high_line_count int, maximum_mobile_line_count int,
        minimum_plan_fee decimal(12,2), required_network_type string,
        guardian_minimum_plan_fee decimal(12,2), guardian_required_network_type string,
        enrollment_min_age decimal(38,10), enrollment_max_age decimal(38,10),
        benefit_end_age decimal(38,10), requires_legal_guardian boolean,
        discount_rate decimal(8,5), discount_amount decimal(12,2),
        effective_start_date date, effective_end_date date""",
    "user_discounts": """
        user_discount_id string, user_id string, bundle_composition_id string,
        discount_id string, status string, start_date date, end_date date""",
    "user_services": """
        user_service_id string, user_id string, service_id string, benefit_type string,
        start_date date""",
    "content_usage": """
        content_usage_id string, user_id string, usage_date date, content_category string,
        content_detail string, data_usage_mb decimal(14,3)""",
}



def _schema(ddl: str) -> StructType:
    schema = StructType()
    for column in ddl.replace("\n", " ").split(", "):
        name, kind = column.split()
        schema = schema.add(name, "integer" if kind == "int" else kind)
    return schema


SOURCE_SCHEMAS = {name: _schema(ddl) for name, ddl in _DDL.items()}
MASTER_TABLES = [name for name in SOURCE_SCHEMAS if name != "content_usage"]
PUBLIC_MASTERS = [
    "plans",
    "age_benefits",
    "plan_age_benefits",
    "additional_services",
    "plan_benefits",
    "discounts",
    "internet_bundle_discount_rules",
    "premium_family_discount_rules",
]

# Columns that may not be null in a source table; the first one is its key.
REQUIRED_COLUMNS = {
    "users": ["user_id", "name", "age", "gender", "subscription_start_date", "current_plan_id"],
    "families": ["family_id", "has_bundle", "has_home_internet"],
    "bundle_discount_compositions": [
        "bundle_composition_id", "family_id", "component_type", "component_role", "status",
        "start_date"],
    "plans": [
        "plan_id", "plan_name", "plan_family", "plan_category", "monthly_fee", "is_unlimited",
        "is_rollover", "network_type", "family_bundle_eligible"],
    "age_benefits": ["age_benefit_id", "benefit_name", "min_age", "includes_safety_box"],
    "plan_age_benefits": ["plan_age_benefit_id", "plan_id", "age_benefit_id"],
    "additional_services": ["service_id", "service_name", "service_category"],
    "plan_benefits": ["plan_benefit_id", "plan_id", "service_id", "benefit_type", "is_selectable"],
    "discounts": ["discount_id", "policy_domain", "benefit_code", "discount_name"],
    "internet_bundle_discount_rules": [
        "internet_bundle_rule_id", "discount_id", "bundle_discount_method", "rule_type",
        "discount_target"],
    "premium_family_discount_rules": [
        "premium_family_rule_id", "discount_id", "benefit_type", "requires_internet",
        "requires_legal_guardian"],
    "user_discounts": [
        "user_discount_id", "user_id", "bundle_composition_id", "discount_id", "status",
        "start_date"],
    "user_services": [
        "user_service_id", "user_id", "service_id", "benefit_type", "start_date"],
    "content_usage": [
        "content_usage_id", "user_id", "usage_date", "content_category", "content_detail",
        "data_usage_mb"],
}
USAGE_GRAIN = ["user_id", "usage_date", "content_category", "content_detail"]
