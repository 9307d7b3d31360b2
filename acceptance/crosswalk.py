"""The test tables seen as the tables the library works on.

The expressions are plain enough for both engines, so one text serves the Spark query and its oracle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from acceptance.registry import table

_TEXT_KEY = "lpad(cast({} as string), {}, '0')"

VIEWS: dict[str, tuple[str, dict[str, str]]] = {
    "branch": (
        "supplier",
        {
            "BRANCH_KEY": "s_suppkey",
            "BRANCH_PHONE": f"case when s_acctbal < 0 or s_suppkey % 7 = 5 then '12345' when s_nationkey = 3 then null "
            f"else {_TEXT_KEY.format('s_suppkey', 10)} end",
            "BRANCH_NAME": "s_name",
            "BRANCH_ZIP": f"case when s_acctbal < 1000 then 'Null' when s_nationkey = 4 then null "
            f"else {_TEXT_KEY.format('s_nationkey', 5)} end",
        },
    ),
    "card": (
        "orders",
        {
            "CARD_KEY": "o_orderkey",
            "YEAR": "year(o_orderdate)",
            "MONTH": "nullif(month(o_orderdate), 2)",
            "DAY": "day(o_orderdate)",
            "AMOUNT": "o_totalprice",
        },
    ),
    "customers": (
        "customer",
        {
            "CUST_KEY": "c_custkey",
            "FIRST_NAME": "concat(lower(c_mktsegment), '-', 'o''NEIL')",
            "MIDDLE_NAME": "c_mktsegment",
            "LAST_NAME": "nullif(upper(c_name), 'CUSTOMER#000000007')",
            "CUST_ZIP": f"case when c_mktsegment = 'BUILDING' then concat('x', c_name) "
            f"else {_TEXT_KEY.format('c_nationkey', 5)} end",
            "CUST_PHONE": f"case when c_mktsegment = 'MACHINERY' then '12' "
            f"else {_TEXT_KEY.format('c_custkey', 7)} end",
            "APT_NO": "nullif(c_nationkey, 0)",
            "STREET_NAME": "c_mktsegment",
        },
    ),
    "event_records": (
        "events",
        {
            "event_id": "event_id",
            "day": "cast(cast(ts as date) as string)",
            "user_id": "user_id",
            "event_type": "event_type",
            "value": "value",
            "props": "props",
        },
    ),
    "part_records": (
        "part",
        {
            "p_partkey": "p_partkey",
            "p_name": "concat(p_name, ', \"', p_type, '\", ')",
            "p_brand": "concat('\"', p_brand, '\"')",
            "p_size": "cast(p_size as bigint)",
            "p_retailprice": "p_retailprice",
        },
    ),
    "plan_attributes": (
        "part",
        {
            "AttributesID": "p_partkey",
            "BeginPrimaryCareCostSharingAfterNumberOfVisits": "cast(p_size as bigint)",
            "BeginPrimaryCareDeductibleCoinsuranceAfterNumberOfCopays": "cast(p_size as bigint) + 1",
            "BenefitPackageId": "cast(p_size as bigint) + 2",
            "BusinessYear": "cast(p_size as bigint) + 2000",
            "ChildOnlyOffering": "p_type",
            "CompositeRatingOffered": "case when p_size > 25 then 'Yes' else '' end",
            "CSRVariationType": "p_brand",
            "DentalOnlyPlan": "case when p_type = 'SMALL' then 'Yes' else 'No' end",
            "DiseaseManagementProgramsOffered": "concat(p_name, ', ', p_type)",
            "FirstTierUtilization": "concat(cast(p_size as string), '%')",
            "HSAOrHRAEmployerContribution": "''",
            "HSAOrHRAEmployerContributionAmount": "''",
            "InpatientCopaymentMaximumDays": "cast(0 as bigint)",
            "IsGuaranteedRate": "'Guaranteed Rate'",
            "IsHSAEligible": "'No'",
            "IsNewPlan": "case when p_size < 10 then 'New' else 'Existing' end",
            "IsNoticeRequiredForPregnancy": "'No'",
            "IsReferralRequiredForSpecialist": "'Yes'",
            "IssuerId": "p_partkey + 10000",
            "MarketCoverage": "p_type",
            "MedicalDrugDeductiblesIntegrated": "'Yes'",
            "MedicalDrugMaximumOutofPocketIntegrated": "'Yes'",
            "MetalLevel": "p_brand",
            "MultipleInNetworkTiers": "'No'",
            "NationalNetwork": "'Yes'",
            "NetworkId": "concat('N', cast(p_partkey as string))",
            "OutOfCountryCoverage": "'No'",
            "OutOfServiceAreaCoverage": "'No'",
            "PlanEffectiveDate": "'2014-01-01'",
            "PlanExpirationDate": "'2014-12-31'",
            "PlanId": "concat(p_brand, '-', cast(p_partkey as string))",
            "PlanLevelExclusions": "concat('\"', p_name)",
            "PlanMarketingName": "concat(p_name, ' \"', p_type, '\"')",
            "PlanType": "p_type",
            "QHPNonQHPTypeId": "'Both'",
            "SecondTierUtilization": "''",
            "ServiceAreaId": "concat('S', cast(p_size as string))",
            "sourcename": "p_type",
            "SpecialtyDrugMaximumCoinsurance": "''",
            "StandardComponentId": "p_brand",
            "StateCode": "p_brand",
            "WellnessProgramOffered": "''",
        },
    ),
    "network": (
        "supplier",
        {
            "BusinessYear": "cast(s_nationkey as bigint) + 2000",
            "StateCode": "concat('N', cast(s_nationkey as string))",
            "IssuerId": "s_suppkey",
            "SourceName": "case when s_acctbal < 0 then 'OPM' else 'HIOS' end",
            "VersionNum": "cast(s_nationkey as bigint)",
            "ImportDate": "'2014-03-19 07:06:49'",
            "IssuerId2": "s_suppkey",
            "StateCode2": "concat('N', cast(s_nationkey as string))",
            "NetworkName": "concat(s_name, ', Inc.')",
            "NetworkId": "concat('N', cast(s_suppkey as string))",
            "NetworkURL": "concat('http://example.com/?q=\"', s_name, '\"')",
            "RowNumber": "cast(s_suppkey as string)",
            "MarketCoverage": "''",
            "DentalOnlyPlan": "'No'",
        },
    ),
    "service_area": (
        "orders",
        {
            # One state has no rows of 1998, another none of source P.
            "BusinessYear": "cast(case when o_orderpriority = '4-NOT SPECIFIED' and year(o_orderdate) = 1998 "
            "then 1997 else year(o_orderdate) end as bigint)",
            "StateCode": "o_orderpriority",
            "IssuerId": "o_custkey",
            "SourceName": "case when o_orderpriority = '5-LOW' and o_orderstatus = 'P' then 'O' "
            "else o_orderstatus end",
            "VersionNum": "'6'",
            "ImportDate": "cast(cast(o_orderdate as date) as string)",
            "IssuerId2": "cast(o_custkey as string)",
            "StateCode2": "o_orderpriority",
            "ServiceAreaId": "concat('S', cast(o_custkey as string))",
            "ServiceAreaName": "concat('Area ', cast(o_custkey as string))",
            "CoverEntireState": "case when o_totalprice > 100000 then 'Yes' else 'No' end",
            "County": "cast(o_custkey as string)",
            "PartialCounty": "''",
            "ZipCodes": "concat(cast(o_orderkey as string), ', ', cast(o_custkey as string))",
            "PartialCountyJustification": "concat('see \"', o_orderpriority, '\", part')",
            "RowNumber": "cast(o_orderkey as string)",
            "MarketCoverage": "''",
            "DentalOnlyPlan": "''",
        },
    ),
    "insurance": (
        "customer",
        {
            "age": "cast(c_nationkey as bigint) + 18",
            "sex": "case when c_mktsegment in ('BUILDING', 'MACHINERY') then 'female' else 'male' end",
            "bmi": "c_acctbal",
            "children": "case when c_acctbal > 5000 then c_custkey else 0 end",
            "smoker": "case when c_acctbal < 0 or c_acctbal > 6000 then 'yes' else 'no' end",
            "region": "concat('region ', cast(c_nationkey as string))",
            "charges": "c_acctbal",
        },
    ),
    "benefits": (
        "lineitem",
        {
            "BenefitName": "concat('Benefit ', cast(l_partkey as string))",
            "BusinessYear": "cast(year(l_shipdate) as string)",
            "EHBVarReason": "case when l_returnflag = 'N' then '' else l_returnflag end",
            "IsCovered": "case when l_linestatus = 'O' then 'Covered' else '' end",
            "IssuerId": "cast(l_suppkey as string)",
            "LimitQty": "cast(cast(l_quantity as int) as string)",
            "LimitUnit": "'Visit(s) per \"Year\"'",
            "MinimumStay": "''",
            "PlanId": "cast(l_orderkey as string)",
            "SourceName": "l_returnflag",
            "StateCode": "concat(l_returnflag, l_linestatus)",
        },
    ),
}


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    source, columns = VIEWS[name]
    return table(spark, sf_dir, source).selectExpr(*(f"{value} AS {column}" for column, value in columns.items()))


def view_sql(name: str) -> str:
    """The same as a parenthesised SELECT."""
    source, columns = VIEWS[name]
    chosen = ", ".join(f"{value} AS {column}" for column, value in columns.items())
    return f"(SELECT {chosen} FROM {source})"
