"""Default HMIS table configurations.

FIXED VALUES: column names and stage codes of the HMIS CSV export, as the
reference's per-table JSON files list them (same keys, same order).  A
user can pass their own dict or JSON path instead.
"""

ENROLLMENT = {
    "person_enrollment_ID": "ProjectEntryID",
    "person_ID": "PersonalID",
    "program_ID": "ProjectID",
    "groupID_column": "HouseholdID",
    "duplicate_check_columns": ["ProjectEntryID", "PersonalID", "ProjectID", "HouseholdID"],
    "columns_to_drop": [
        "OtherResidencePrior", "TimesHomelessPastThreeYears", "MonthsHomelessPastThreeYears",
        "DateOfEngagement", "InPermanentHousing", "ResidentialMoveInDate", "DateOfPATHStatus",
        "ClientEnrolledInPATH", "ReasonNotEnrolled", "WorstHousingSituation", "PercentAMI",
        "AddressDataQuality", "DateOfBCPStatus", "FYSBYouth", "SexualOrientation",
        "FormerWardChildWelfare", "ChildWelfareYears", "ChildWelfareMonths",
        "FormerWardJuvenileJustice", "JuvenileJusticeYears", "JuvenileJusticeMonths",
        "IncarceratedParentStatus", "ReferralSource", "CountOutreachReferralApproaches",
        "ExchangeForSex", "ExchangeForSexPastThreeMonths", "CountOfExchangeForSex",
        "AskedOrForcedToExchangeForSex", "AskedOrForcedToExchangeForSexPastThreeMonths",
        "WorkPlaceViolenceThreats", "WorkplacePromiseDifference", "CoercedToContinueWork",
        "LaborExploitPastThreeMonths", "HPScreeningScore", "VAMCStation", "DateDeleted",
        "DisablingCondition", "EntryFromStreetESSH", "HouseholdDynamics",
        "SexualOrientationGenderIDYouth", "SexualOrientationGenderIDFam", "HousingIssuesYouth",
        "HousingIssuesFam", "SchoolEducationalIssuesYouth", "SchoolEducationalIssuesFam",
        "UnemploymentYouth", "UnemploymentFam", "MentalHealthIssuesYouth", "MentalHealthIssuesFam",
        "HealthIssuesYouth", "HealthIssuesFam", "PhysicalDisabilityYouth", "PhysicalDisabilityFam",
        "MentalDisabilityYouth", "MentalDisabilityFam", "AbuseAndNeglectYouth", "AbuseAndNeglectFam",
        "AlcoholDrugAbuseYouth", "AlcoholDrugAbuseFam", "InsufficientIncome", "ActiveMilitaryParent",
        "IncarceratedParent", "DateCreated", "DateUpdated", "UserID", "ExportID"],
    "categorical_var": ["ResidencePrior", "ResidencePriorLengthOfStay"],
    "time_var": ["EntryDate", "DateToStreetESSH"],
    "entry_date": "EntryDate",
}

EXIT = {
    "person_enrollment_ID": "ProjectEntryID",
    "destination_column": "Destination",
    "duplicate_check_columns": ["ProjectEntryID"],
    "columns_to_drop": [
        "ExitID", "PersonalID", "OtherDestination", "AssessmentDisposition", "OtherDisposition",
        "HousingAssessment", "SubsidyInformation", "ConnectionWithSOAR", "WrittenAftercarePlan",
        "AssistanceMainstreamBenefits", "PermanentHousingPlacement", "TemporaryShelterPlacement",
        "ExitCounseling", "FurtherFollowUpServices", "ScheduledFollowUpContacts", "ResourcePackage",
        "OtherAftercarePlanOrAction", "ProjectCompletionStatus", "EarlyExitReason",
        "FamilyReunificationAchieved", "DateCreated", "DateUpdated", "UserID", "DateDeleted",
        "ExportID"],
    "categorical_var": ["Destination"],
    "time_var": ["ExitDate"],
}

CLIENT = {
    "person_ID": "PersonalID",
    "duplicate_check_columns": ["PersonalID", "AmIndAKNative", "Asian", "BlackAfAmerican",
                                "NativeHIOtherPacific", "White", "Ethnicity", "Gender",
                                "VeteranStatus", "DOB"],
    "columns_to_drop": ["RaceNone", "DateCreated", "DateUpdated", "UserID", "DateDeleted",
                        "ExportID", "OtherGender"],
    "categorical_var": ["AmIndAKNative", "Asian", "BlackAfAmerican", "NativeHIOtherPacific", "White",
                        "Ethnicity", "Gender", "VeteranStatus", "WorldWarII", "KoreanWar",
                        "VietnamWar", "DesertStorm", "AfghanistanOEF", "IraqOIF", "IraqOND",
                        "OtherTheater", "MilitaryBranch", "DischargeStatus"],
    "time_var": ["DOB", "YearEnteredService", "YearSeparated"],
    "dob_column": "DOB",
    "boolean": ["AmIndAKNative", "Asian", "BlackAfAmerican", "NativeHIOtherPacific", "White",
                "Ethnicity", "VeteranStatus", "WorldWarII", "KoreanWar", "VietnamWar", "DesertStorm",
                "AfghanistanOEF", "IraqOIF", "IraqOND", "OtherTheater"],
    "numeric_code": ["Gender", "MilitaryBranch", "DischargeStatus"],
    "name_columns": ["FirstName", "LastName"],
}

DISABILITIES = {
    "person_enrollment_ID": "ProjectEntryID",
    "duplicate_check_columns": ["ProjectEntryID", "DataCollectionStage", "DisabilityType",
                                "DisabilityResponse"],
    "columns_to_drop": ["DisabilitiesID", "PersonalID", "InformationDate", "IndefiniteAndImpairs",
                        "ReceivingServices", "DocumentationOnFile", "PATHHowConfirmed",
                        "PATHSMIInformation", "DateCreated", "DateUpdated", "UserID", "DateDeleted",
                        "ExportID", "TCellSource", "ViralLoadAvailable", "ViralLoad",
                        "ViralLoadSource", "TCellCountAvailable", "TCellCount"],
    "categorical_var": ["DisabilityResponse"],
    "collection_stage_column": "DataCollectionStage",
    "entry_stage_val": 1, "exit_stage_val": 3, "update_stage_val": 2,
    "annual_assessment_stage_val": 5, "post_exit_stage_val": 6,
    "type_column": "DisabilityType",
    "response_column": "DisabilityResponse",
}

EMPLOYMENT_EDUCATION = {
    "person_enrollment_ID": "ProjectEntryID",
    "duplicate_check_columns": ["ProjectEntryID", "Employed", "DataCollectionStage"],
    "columns_to_drop": ["EmploymentEducationID", "PersonalID", "InformationDate",
                        "LastGradeCompleted", "SchoolStatus", "EmploymentType", "NotEmployedReason",
                        "DateCreated", "DateUpdated", "UserID", "DateDeleted", "ExportID"],
    "categorical_var": ["Employed"],
    "collection_stage_column": "DataCollectionStage",
    "entry_stage_val": 1, "exit_stage_val": 3, "update_stage_val": 2,
    "annual_assessment_stage_val": 5, "post_exit_stage_val": 6,
}

HEALTH_DV = {
    "person_enrollment_ID": "ProjectEntryID",
    "duplicate_check_columns": ["ProjectEntryID", "DomesticViolenceVictim", "GeneralHealthStatus",
                                "PregnancyStatus", "DataCollectionStage"],
    "columns_to_drop": ["HealthAndDVID", "PersonalID", "InformationDate", "WhenOccurred",
                        "DentalHealthStatus", "MentalHealthStatus", "DueDate", "DateCreated",
                        "DateUpdated", "UserID", "DateDeleted", "ExportID"],
    "categorical_var": ["DomesticViolenceVictim", "GeneralHealthStatus", "PregnancyStatus"],
    "collection_stage_column": "DataCollectionStage",
    "entry_stage_val": 1, "exit_stage_val": 3, "update_stage_val": 2,
    "annual_assessment_stage_val": 5, "post_exit_stage_val": 6,
}

_INCOME_COLS = ["IncomeFromAnySource", "TotalMonthlyIncome", "Earned", "EarnedAmount", "TANF",
                "TANFAmount", "GA", "GAAmount", "ChildSupport", "ChildSupportAmount",
                "BenefitsFromAnySource", "SNAP", "WIC", "TANFChildCare", "RentalAssistanceOngoing",
                "RentalAssistanceTemp", "InsuranceFromAnySource", "Medicaid", "Medicare", "SCHIP"]

INCOME = {
    "person_enrollment_ID": "ProjectEntryID",
    "duplicate_check_columns": ["ProjectEntryID", "IncomeFromAnySource", "TotalMonthlyIncome", "Earned",
                                "EarnedAmount", "TANF", "TANFAmount", "GA", "GAAmount", "ChildSupport",
                                "ChildSupportAmount", "BenefitsFromAnySource", "SNAP", "WIC",
                                "TANFChildCare", "RentalAssistanceOngoing", "RentalAssistanceTemp",
                                "InsuranceFromAnySource", "Medicaid", "Medicare", "SCHIP",
                                "DataCollectionStage"],
    "columns_to_drop": ["IncomeBenefitsID", "PersonalID", "InformationDate", "Unemployment",
                        "UnemploymentAmount", "SSI", "SSIAmount", "SSDI", "SSDIAmount",
                        "VADisabilityService", "VADisabilityServiceAmount", "VADisabilityNonService",
                        "VADisabilityNonServiceAmount", "PrivateDisability", "PrivateDisabilityAmount",
                        "WorkersComp", "WorkersCompAmount", "SocSecRetirement",
                        "SocSecRetirementAmount", "Pension", "PensionAmount", "Alimony",
                        "AlimonyAmount", "OtherIncomeSource", "OtherIncomeAmount",
                        "OtherIncomeSourceIdentify", "TANFTransportation", "OtherTANF",
                        "OtherBenefitsSource", "OtherBenefitsSourceIdentify", "NoMedicaidReason",
                        "NoMedicareReason", "NoSCHIPReason", "VAMedicalServices", "NoVAMedReason",
                        "EmployerProvided", "NoEmployerProvidedReason", "COBRA", "NoCOBRAReason",
                        "PrivatePay", "NoPrivatePayReason", "StateHealthIns", "NoStateHealthInsReason",
                        "HIVAIDSAssistance", "NoHIVAIDSAssistanceReason", "ADAP", "NoADAPReason",
                        "DateCreated", "DateUpdated", "UserID", "DateDeleted", "ExportID"],
    "categorical_var": ["IncomeFromAnySource", "Earned", "TANF", "GA", "ChildSupport",
                        "BenefitsFromAnySource", "SNAP", "WIC", "TANFChildCare",
                        "RentalAssistanceOngoing", "RentalAssistanceTemp", "InsuranceFromAnySource",
                        "Medicaid", "Medicare", "SCHIP"],
    "collection_stage_column": "DataCollectionStage",
    "entry_stage_val": 1, "exit_stage_val": 3, "update_stage_val": 2,
    "annual_assessment_stage_val": 5, "post_exit_stage_val": 6,
    "columns_to_take_max": _INCOME_COLS,
}

PROJECT = {
    "program_ID": "ProjectID",
    "duplicate_check_columns": ["ProjectID", "OrganizationID", "ProjectName", "ProjectType"],
    "columns_to_drop": ["ContinuumProject", "ResidentialAffiliation", "TrackingMethod",
                        "TargetPopulation", "DateCreated", "DateUpdated", "UserID", "DateDeleted",
                        "ExportID"],
    "project_type_column": "ProjectType",
}

METADATA = {"enrollment": ENROLLMENT, "exit": EXIT, "client": CLIENT, "disabilities": DISABILITIES,
            "employment_education": EMPLOYMENT_EDUCATION, "health_dv": HEALTH_DV, "income": INCOME,
            "project": PROJECT}

DEFAULT_FILES = {"enrollment": "Enrollment.csv", "exit": "Exit.csv", "client": "Client.csv",
                 "disabilities": "Disabilities.csv", "employment_education": "EmploymentEducation.csv",
                 "health_dv": "HealthAndDV.csv", "income": "IncomeBenefits.csv",
                 "project": "Project.csv"}
