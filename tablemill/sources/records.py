"""The declared record types of the delimited sources and how their lines are written."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# Holds the text of a line that does not fit its record type, and null for every line that does.
REJECTED_LINE = "rejected_line"


FIELD_TYPES = {"bigint": T.LongType(), "double": T.DoubleType(), "string": T.StringType()}


@dataclass(frozen=True)
class RecordType:
    """Field names and types in line order, the separator, and whether quotes group text or are text themselves."""

    name: str
    fields: str
    separator: str
    quoted: bool

    @property
    def schema(self) -> T.StructType:
        pairs = (field.split() for field in self.fields.split(","))
        return T.StructType([T.StructField(name, FIELD_TYPES[kind]) for name, kind in pairs])

    @property
    def landed_schema(self) -> T.StructType:
        """The record's fields plus the column for rejected lines."""
        return self.schema.add(REJECTED_LINE, T.StringType())

    @property
    def text_schema(self) -> T.StructType:
        """The same columns as text, which is how lines are cut before their numbers are converted."""
        return T.StructType([T.StructField(f.name, T.StringType()) for f in self.landed_schema.fields])

    @property
    def header(self) -> str:
        return self.separator.join(f.name for f in self.schema.fields)


# The fields of the five record types, in line order, as the published files have them.
PLAN_ATTRIBUTES_FIELDS = """
    AttributesID bigint,
    BeginPrimaryCareCostSharingAfterNumberOfVisits bigint,
    BeginPrimaryCareDeductibleCoinsuranceAfterNumberOfCopays bigint,
    BenefitPackageId bigint,
    BusinessYear bigint,
    ChildOnlyOffering string,
    CompositeRatingOffered string,
    CSRVariationType string,
    DentalOnlyPlan string,
    DiseaseManagementProgramsOffered string,
    FirstTierUtilization string,
    HSAOrHRAEmployerContribution string,
    HSAOrHRAEmployerContributionAmount string,
    InpatientCopaymentMaximumDays bigint,
    IsGuaranteedRate string,
    IsHSAEligible string,
    IsNewPlan string,
    IsNoticeRequiredForPregnancy string,
    IsReferralRequiredForSpecialist string,
    IssuerId bigint,
    MarketCoverage string,
    MedicalDrugDeductiblesIntegrated string,
    MedicalDrugMaximumOutofPocketIntegrated string,
    MetalLevel string,
    MultipleInNetworkTiers string,
    NationalNetwork string,
    NetworkId string,
    OutOfCountryCoverage string,
    OutOfServiceAreaCoverage string,
    PlanEffectiveDate string,
    PlanExpirationDate string,
    PlanId string,
    PlanLevelExclusions string,
    PlanMarketingName string,
    PlanType string,
    QHPNonQHPTypeId string,
    SecondTierUtilization string,
    ServiceAreaId string,
    sourcename string,
    SpecialtyDrugMaximumCoinsurance string,
    StandardComponentId string,
    StateCode string,
    WellnessProgramOffered string
"""
NETWORK_FIELDS = """
    BusinessYear bigint,
    StateCode string,
    IssuerId bigint,
    SourceName string,
    VersionNum bigint,
    ImportDate string,
    IssuerId2 bigint,
    StateCode2 string,
    NetworkName string,
    NetworkId string,
    NetworkURL string,
    RowNumber string,
    MarketCoverage string,
    DentalOnlyPlan string
"""
SERVICE_AREA_FIELDS = """
    BusinessYear bigint,
    StateCode string,
    IssuerId bigint,
    SourceName string,
    VersionNum string,
    ImportDate string,
    IssuerId2 string,
    StateCode2 string,
    ServiceAreaId string,
    ServiceAreaName string,
    CoverEntireState string,
    County string,
    PartialCounty string,
    ZipCodes string,
    PartialCountyJustification string,
    RowNumber string,
    MarketCoverage string,
    DentalOnlyPlan string
"""
INSURANCE_FIELDS = """
    age bigint,
    sex string,
    bmi double,
    children bigint,
    smoker string,
    region string,
    charges double
"""
BENEFITS_COST_SHARING_FIELDS = """
    BenefitName string,
    BusinessYear string,
    EHBVarReason string,
    IsCovered string,
    IssuerId string,
    LimitQty string,
    LimitUnit string,
    MinimumStay string,
    PlanId string,
    SourceName string,
    StateCode string
"""

PLAN_ATTRIBUTES = RecordType("PlanAttributes", PLAN_ATTRIBUTES_FIELDS, "\t", quoted=False)
NETWORK = RecordType("Network", NETWORK_FIELDS, ",", quoted=True)
SERVICE_AREA = RecordType("ServiceArea", SERVICE_AREA_FIELDS, ",", quoted=True)
INSURANCE = RecordType("Insurance", INSURANCE_FIELDS, "\t", quoted=False)
BENEFITS_COST_SHARING = RecordType("BenefitsCostSharing", BENEFITS_COST_SHARING_FIELDS, "\t", quoted=False)

RECORD_TYPES = {r.name: r for r in (PLAN_ATTRIBUTES, NETWORK, SERVICE_AREA, INSURANCE, BENEFITS_COST_SHARING)}
