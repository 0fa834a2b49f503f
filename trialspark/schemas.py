"""Fixed schemas and allowed values."""

from __future__ import annotations

# Registry CSV headers and the harmonized name each one maps to.
CSV_TO_HARMONIZED = {
    "NCT Number": "nct_id",
    "Study Title": "title",
    "Study URL": "study_url",
    "Acronym": "acronym",
    "Study Status": "overall_status",
    "Study Results": "has_results",
    "Study Type": "study_type",
    "Study Design": "study_design",
    "Brief Summary": "brief_summary",
    "Conditions": "conditions",
    "Interventions": "interventions",
    "Primary Outcome Measures": "primary_outcome_measures",
    "Secondary Outcome Measures": "secondary_outcome_measures",
    "Other Outcome Measures": "other_outcome_measures",
    "Sponsor": "lead_sponsor",
    "Collaborators": "collaborators",
    "Funder Type": "funder_type",
    "Sex": "sex",
    "Age": "minimum_age",
    "Phases": "study_phase",
    "Enrollment": "enrollment",
    "Start Date": "start_date",
    "Primary Completion Date": "primary_completion_date",
    "Completion Date": "completion_date",
    "First Posted": "first_posted",
    "Results First Posted": "results_first_posted",
    "Last Update Posted": "last_update_posted",
    "Locations": "locations",
    "Study Documents": "document_urls",
    "Other IDs": "other_ids",
}

CSV_DDL = ", ".join(f"`{name}` string" for name in CSV_TO_HARMONIZED)

CSV_LIST_COLUMNS = ("conditions", "interventions", "collaborators", "document_urls", "locations")
CSV_DATE_COLUMNS = (
    "start_date",
    "primary_completion_date",
    "completion_date",
    "first_posted",
    "last_update_posted",
)

# The enforced output table, in column order.
HARMONIZED_TYPES = {
    "nct_id": "string",
    "title": "string",
    "official_title": "string",
    "brief_title": "string",
    "study_url": "string",
    "acronym": "string",
    "overall_status": "string",
    "study_type": "string",
    "study_phase": "string",
    "has_results": "boolean",
    "brief_summary": "string",
    "detailed_description": "string",
    "conditions": "array<string>",
    "interventions": "array<string>",
    "condition_meshes": "array<string>",
    "sex": "string",
    "minimum_age": "string",
    "maximum_age": "string",
    "healthy_volunteers": "boolean",
    "enrollment": "bigint",
    "start_date": "date",
    "primary_completion_date": "date",
    "completion_date": "date",
    "first_posted": "date",
    "last_update_posted": "date",
    "lead_sponsor": "string",
    "collaborators": "array<string>",
    "document_urls": "array<string>",
    "document_files": "array<string>",
    "locations": "array<string>",
    "data_source": "string",
    "shard_hash": "bigint",
    "processing_timestamp": "timestamp",
}

# Nested registry record, every part optional.
_NAMED = "array<struct<name:string,`class`:string>>"
_DATED = "struct<date:string,type:string>"
_MESHES = "struct<meshes:array<struct<id:string,term:string>>>"
STUDY_DDL = f"""
protocolSection struct<
  identificationModule:struct<nctId:string,orgStudyIdInfo:struct<id:string>,
    organization:struct<fullName:string,`class`:string>,
    briefTitle:string,officialTitle:string,acronym:string>,
  statusModule:struct<statusVerifiedDate:string,overallStatus:string,
    startDateStruct:{_DATED},primaryCompletionDateStruct:{_DATED},completionDateStruct:{_DATED},
    studyFirstPostDateStruct:{_DATED},lastUpdatePostDateStruct:{_DATED}>,
  sponsorCollaboratorsModule:struct<leadSponsor:struct<name:string,`class`:string>,collaborators:{_NAMED}>,
  descriptionModule:struct<briefSummary:string,detailedDescription:string>,
  conditionsModule:struct<conditions:array<string>,keywords:array<string>>,
  designModule:struct<studyType:string,phases:array<string>,enrollmentInfo:struct<count:bigint,type:string>>,
  armsInterventionsModule:struct<
    armGroups:array<struct<label:string,type:string,description:string>>,
    interventions:array<struct<type:string,name:string,description:string,
      armGroupLabels:array<string>,otherNames:array<string>>>>,
  outcomesModule:struct<
    primaryOutcomes:array<struct<measure:string,description:string,timeFrame:string>>,
    secondaryOutcomes:array<struct<measure:string,description:string,timeFrame:string>>,
    otherOutcomes:array<struct<measure:string,description:string,timeFrame:string>>>,
  eligibilityModule:struct<eligibilityCriteria:string,sex:string,minimumAge:string,maximumAge:string,
    healthyVolunteers:boolean,stdAges:array<string>>,
  contactsLocationsModule:struct<locations:array<struct<facility:string,city:string,state:string,
    country:string,zip:string,geoPoint:struct<lat:double,lon:double>>>>,
  referencesModule:struct<references:array<struct<pmid:string,type:string,citation:string>>>>,
derivedSection struct<conditionBrowseModule:{_MESHES}>,
documentSection struct<largeDocumentModule:struct<largeDocs:array<struct<filename:string,size:bigint,version:string>>>>,
hasResults boolean
""".replace("\n", " ")

# Allowed values of the enumerated fields.
STUDY_STATUSES = (
    "COMPLETED",
    "RECRUITING",
    "NOT_YET_RECRUITING",
    "ENROLLING_BY_INVITATION",
    "ACTIVE_NOT_RECRUITING",
    "SUSPENDED",
    "TERMINATED",
    "WITHDRAWN",
    "UNKNOWN",
    "WITHHELD",
    "APPROVED_FOR_MARKETING",
    "NO_LONGER_AVAILABLE",
    "AVAILABLE",
    "TEMPORARILY_NOT_AVAILABLE",
)
RECRUITING_STATUSES = ("RECRUITING", "NOT_YET_RECRUITING", "ENROLLING_BY_INVITATION")
STUDY_TYPES = ("INTERVENTIONAL", "OBSERVATIONAL", "EXPANDED_ACCESS")
STUDY_PHASES = (
    "EARLY_PHASE_1",
    "PHASE_1",
    "PHASE_1_PHASE_2",
    "PHASE_2",
    "PHASE_2_PHASE_3",
    "PHASE_3",
    "PHASE_4",
    "NOT_APPLICABLE",
    "NA",
)
SEXES = ("ALL", "FEMALE", "MALE")
RESULT_FLAGS = ("YES", "NO", "UNKNOWN")

# Spellings of a phase besides its own name.
PHASE_ALIASES = {
    "PHASE1": "PHASE_1",
    "PHASE2": "PHASE_2",
    "PHASE3": "PHASE_3",
    "PHASE4": "PHASE_4",
    "N/A": "NA",
}
