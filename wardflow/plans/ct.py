"""Care-and-treatment load specs.

Scan shape of these forms: form -> PatientExtract (form.PatientId = P.ID) ->
Facility (P.FacilityId = F.Id, F.Voided = 0); PatientID/PatientPK come from the
patient, SiteCode/FacilityName from the facility.  Latest rules of this family
group by patient and facility columns, so they run after the parent joins.

FIXED VALUES: the source and target table names, the output column lists (in
order), key columns, date bounds and numeric thresholds below are the load
jobs' contracts and must equal them; they are stated as given.
"""

from wardflow.plans import vocab as V
from wardflow.plans.spec import Latest, LoadSpec, Lookup, Parent, cols, date_casts, rule

PATIENT = Parent("PatientExtract", (("PatientId", "ID"),),
                 columns=(("PatientCccNumber", "PatientID"), ("PatientPID", "PatientPK"), ("Gender", "Gender"),
                          ("FacilityId", "FacilityId"), ("Emr", "Emr"), ("Project", "Project")))
# parents of texts that take the form's own Emr, Project, Gender or FacilityName, or the patient's ID
PATIENT_KEYS = Parent("PatientExtract", (("PatientId", "ID"),),
                      columns=(("PatientCccNumber", "PatientID"), ("PatientPID", "PatientPK"),
                               ("Gender", "PatientGender"), ("FacilityId", "FacilityId")))
PATIENT_KEYS_EMR = Parent("PatientExtract", (("PatientId", "ID"),),
                          columns=PATIENT_KEYS.columns + (("Emr", "Emr"), ("Project", "Project")))
PATIENT_WITH_ID = Parent("PatientExtract", (("PatientId", "ID"),), columns=PATIENT.columns + (("ID", "ID"),))
FACILITY = Parent("Facility", (("FacilityId", "Id"),), where="CAST(Voided AS INT) = 0",
                  columns=(("Code", "SiteCode"), ("Name", "FacilityName")))
FACILITY_CODE = Parent("Facility", (("FacilityId", "Id"),), where="CAST(Voided AS INT) = 0",
                       columns=(("Code", "SiteCode"),))
FACILITY_ANY = Parent("Facility", (("FacilityId", "Id"),), columns=(("Code", "SiteCode"), ("Name", "FacilityName")))
GENDER_OK = "Gender <> 'Unknown'"
PATIENT_GENDER_OK = "PatientGender <> 'Unknown'"
CODE_OK = "try_cast(SiteCode AS INT) > 0"
CT_PARENTS = (PATIENT, FACILITY)
CT_PARENTS_ID = (PATIENT_WITH_ID, FACILITY)
HASH_ID_PK = (("PatientID", "PatientIDHash"), ("PatientPK", "PatientPKHash"))


def d(col, lo, hi="today", fill="1900-01-01"):
    return rule(col, "date", lo=lo, hi=hi, fill=fill)


def rc(col, mapping, default="keep"):
    return rule(col, "recode", mapping=tuple((t, tuple(v)) for t, v in mapping.items()), default=default)


def num(col, lo=None, hi=None, fill=999):
    return rule(col, "number", lo=lo, hi=hi, fill=fill)


# scan texts that map the patient's project names in the select list
PROJECT_CASE_IN_SCAN = {"p01", "p03", "p06", "p09", "p10", "p11", "p14", "p16", "p17", "p18", "p19", "p20",
                        "p21", "p22", "p23"}


def ct(pid, name, source, target, columns, delta, where=(GENDER_OK, CODE_OK), parents=CT_PARENTS, **kw):
    kw.setdefault("hashes", HASH_ID_PK)
    if pid in PROJECT_CASE_IN_SCAN:
        kw["select_rules"] = (rc("Project", V.PROJECT_IN_SCAN),)
    return LoadSpec(name=f"{pid}_{name}", source=source, target=target, columns=cols(columns),
                    delta_keys=tuple(delta), parents=parents, where=tuple(where), module="ct", **kw)


VISIT_DAY = ("cast(VisitDate as date)", "VisitDate")

SPECS = [
    ct("p01", "art_patients", "PatientArtExtract", "CT_ARTPatients",
       "ID,PatientID,PatientPK,SiteCode,FacilityName,AgeEnrollment,AgeARTStart,AgeLastVisit,RegistrationDate,"
       "PatientSource,Gender,StartARTDate,PreviousARTStartDate,PreviousARTRegimen,StartARTAtThisFacility,StartRegimen,"
       "StartRegimenLine,LastARTDate,LastRegimen,LastRegimenLine,Duration,ExpectedReturn,Provider,LastVisit,ExitReason,"
       "ExitDate,Emr,Project,DOB,PreviousARTUse,PreviousARTPurpose,DateLastUsed,DateAsOf,Date_Created,"
       "Date_Last_Modified,recorduuid,voided",
       ("PatientPK", "SiteCode"), where=(PATIENT_GENDER_OK, CODE_OK), parents=(PATIENT_KEYS_EMR, FACILITY),
       latest=Latest(("PatientPK", "SiteCode"), ("cast(Created as date)",), stage="joined"),
       rules=(d("DOB", "1900-01-01"),
              *[d(c, "1980-01-01") for c in ("StartARTDate", "StartARTAtThisFacility", "LastARTDate", "RegistrationDate",
                                             "PreviousARTStartDate", "ExpectedReturn", "LastVisit", "ExitDate")],
              rc("Emr", V.EMR_NAMES), rc("Project", V.PROJECT_NAMES),
              num("Duration", lo=0), num("AgeARTStart", 0, 120), num("AgeLastVisit", 0, 120),
              num("AgeEnrollment", 0, 120)),
       lookups=(Lookup("ExitReason", "lkp_exit_reason"), Lookup("PreviousARTRegimen", "lkp_regimen"),
                Lookup("StartRegimen", "lkp_regimen"), Lookup("LastRegimen", "lkp_regimen"),
                Lookup("PatientSource", "lkp_patient_source")),
       derived=(("DateAsOf", "{as_of}"),)),
    ct("p02", "adverse_events", "PatientAdverseEventExtract", "CT_AdverseEvents",
       "PatientID,PatientPK,SiteCode,AdverseEvent,AdverseEventStartDate,AdverseEventEndDate,Severity,VisitDate,EMR,"
       "Project,AdverseEventCause,AdverseEventRegimen,AdverseEventActionTaken,AdverseEventClinicalOutcome,"
       "AdverseEventIsPregnant,Date_Created,Date_Last_Modified,recorduuid,voided,LoadDate",
       ("SiteCode", "PatientPK", VISIT_DAY), where=(CODE_OK,), parents=(PATIENT_KEYS, FACILITY), write_partitions=50,
       derived=(("LoadDate", "CAST({as_of} AS TIMESTAMP_NTZ)"),),
       rules=(d("AdverseEventStartDate", "1980-01-01"), d("AdverseEventEndDate", "1980-01-01"),
              rc("Severity", V.AE_SEVERITY), rc("AdverseEventActionTaken", V.AE_ACTION),
              rc("AdverseEventCause", V.AE_CAUSE), rc("AdverseEventClinicalOutcome", V.AE_OUTCOME)),
       select_rules=(rc("Severity", {"Mild": ["1"], "Moderate": ["2"], "Severe": ["3"]}),),
       lookups=(Lookup("AdverseEventRegimen", "lkp_regimen"), Lookup("AdverseEvent", "lkp_adverse_events"))),
    ct("p03", "allergies_chronic_illness", "AllergiesChronicIllnessExtract", "CT_AllergiesChronicIllness",
       "ID,PatientID,PatientPK,SiteCode,FacilityName,VisitID,VisitDate,Emr,Project,ChronicIllness,ChronicOnsetDate,"
       "knownAllergies,AllergyCausativeAgent,AllergicReaction,AllergySeverity,AllergyOnsetDate,Skin,Eyes,ENT,Chest,CVS,"
       "Abdomen,CNS,Genitourinary,Date_Created,Date_Last_Modified,recorduuid,voided",
       ("SiteCode", "PatientPK", "VisitID"),
       rules=(d("ChronicOnsetDate", "1900-01-01"), rc("AllergySeverity", V.ALLERGY_SEVERITY)),
       lookups=(Lookup("ChronicIllness", "lkp_chronic_illness"),
                Lookup("AllergyCausativeAgent", "lkp_allergy_causative_agent"),
                Lookup("AllergicReaction", "lkp_allergic_reaction"))),
    ct("p04", "cancer_screening", "CancerScreeningExtract", "CT_CancerScreening",
       "Sitecode,PatientPK,PatientID,Emr,Project,Voided,Id,FacilityName,VisitType,VisitID,VisitDate,SmokesCigarette,"
       "NumberYearsSmoked,NumberCigarettesPerDay,OtherFormTobacco,TakesAlcohol,HIVStatus,FamilyHistoryOfCa,"
       "PreviousCaTreatment,SymptomsCa,CancerType,FecalOccultBloodTest,TreatmentOccultBlood,Colonoscopy,"
       "TreatmentColonoscopy,EUA,TreatmentRetinoblastoma,RetinoblastomaGene,TreatmentEUA,DRE,TreatmentDRE,PSA,"
       "TreatmentPSA,VisualExamination,TreatmentVE,Cytology,TreatmentCytology,Imaging,TreatmentImaging,Biopsy,"
       "TreatmentBiopsy,PostTreatmentComplicationCause,OtherPostTreatmentComplication,ReferralReason,ScreeningMethod,"
       "TreatmentToday,ReferredOut,NextAppointmentDate,ScreeningType,HPVScreeningResult,TreatmentHPV,"
       "VIAScreeningResult,VIAVILIScreeningResult,VIATreatmentOptions,PAPSmearScreeningResult,TreatmentPapSmear,"
       "ReferalOrdered,Colposcopy,TreatmentColposcopy,BiopsyCINIIandAbove,BiopsyCINIIandBelow,BiopsyNotAvailable,CBE,"
       "TreatmentCBE,Ultrasound,TreatmentUltraSound,IfTissueDiagnosis,DateTissueDiagnosis,ReasonNotDone,FollowUpDate,"
       "Referred,ReasonForReferral,RecordUUID,Date_Created,Date_Last_Modified,Created,LoadDate",
       ("SiteCode", "PatientPK", "VisitID"), where=(PATIENT_GENDER_OK,), parents=(PATIENT_KEYS, FACILITY_ANY),
       write_partitions=50, derived=(("LoadDate", "{as_of}"),),
       notes="diffed against its own target (the source job diffs against the cervical screening table)"),
    ct("p05", "cervical_cancer_screening", "CervicalCancerScreeningExtract", "CT_CervicalCancerScreening",
       "SiteCode,PatientPK,PatientID,Emr,Project,Voided,Processed,Id,FacilityName,VisitID,VisitDate,VisitType,"
       "ScreeningMethod,TreatmentToday,ReferredOut,NextAppointmentDate,ScreeningType,ScreeningResult,"
       "PostTreatmentComplicationCause,OtherPostTreatmentComplication,ReferralReason,Created,Date_Created,"
       "Date_Last_Modified",
       ("SiteCode", "PatientPK", "VisitID"), where=(PATIENT_GENDER_OK, "CAST(Voided AS INT) = 0"),
       parents=(PATIENT_KEYS, FACILITY_CODE), write_partitions=50),
    ct("p06", "contact_listing", "ContactListingExtract", "CT_ContactListing",
       "ID,PatientID,PatientPK,SiteCode,FacilityName,Emr,Project,PartnerPersonID,ContactAge,ContactSex,"
       "ContactMaritalStatus,RelationshipWithPatient,ScreenedForIpv,IpvScreening,IPVScreeningOutcome,"
       "CurrentlyLivingWithIndexClient,KnowledgeOfHivStatus,PnsApproach,ContactPatientPK,DateCreated,Date_Created,"
       "Date_Last_Modified,recorduuid,voided",
       ("SiteCode", "PatientPK"),
       latest=Latest(("PatientPK", "SiteCode", "ContactAge"), ("cast(Created as date)",), stage="joined"),
       rules=(num("ContactAge", 0, 120), rc("ContactSex", V.CONTACT_SEX),
              rc("RelationshipWithPatient", V.CONTACT_RELATION), rc("IPVScreeningOutcome", V.IPV_OUTCOME),
              rc("KnowledgeOfHivStatus", V.KNOWS_HIV_STATUS)),
       hashes=HASH_ID_PK + (("ContactPatientPK", "ContactPatientPKHash"),)),
    ct("p07", "covid", "CovidExtract", "CT_Covid",
       "ID,PatientPK,PatientID,Emr,Project,SiteCode,FacilityName,VisitID,Covid19AssessmentDate,ReceivedCOVID19Vaccine,"
       "DateGivenFirstDose,FirstDoseVaccineAdministered,DateGivenSecondDose,SecondDoseVaccineAdministered,"
       "VaccinationStatus,VaccineVerification,BoosterGiven,BoosterDose,BoosterDoseDate,EverCOVID19Positive,"
       "COVID19TestDate,PatientStatus,AdmissionStatus,AdmissionUnit,MissedAppointmentDueToCOVID19,"
       "COVID19PositiveSinceLasVisit,COVID19TestDateSinceLastVisit,PatientStatusSinceLastVisit,"
       "AdmissionStatusSinceLastVisit,AdmissionStartDate,AdmissionEndDate,AdmissionUnitSinceLastVisit,"
       "SupplementalOxygenReceived,PatientVentilated,TracingFinalOutcome,CauseOfDeath,BoosterDoseVerified,Sequence,"
       "COVID19TestResult,Date_Created,Date_Last_Modified,recorduuid,voided",
       ("SiteCode", "PatientPK", "VisitID"), parents=CT_PARENTS_ID,
       select=date_casts("Covid19AssessmentDate", "DateGivenFirstDose", "DateGivenSecondDose", "BoosterDoseDate",
                         "COVID19TestDate", "COVID19TestDateSinceLastVisit", "AdmissionStartDate", "AdmissionEndDate"),
       rules=(d("Covid19AssessmentDate", "1980-01-01"), d("DateGivenFirstDose", "1980-01-01"),
              d("DateGivenSecondDose", "1980-01-01"), rc("VaccinationStatus", V.VACCINATION_STATUS))),
    ct("p08", "defaulter_tracing", "DefaulterTracingExtract", "CT_DefaulterTracing",
       "ID,PatientPK,PatientID,Emr,Project,SiteCode,FacilityName,VisitID,VisitDate,EncounterId,TracingType,"
       "TracingOutcome,AttemptNumber,IsFinalTrace,TrueStatus,CauseOfDeath,Comments,BookingDate,Date_Created,"
       "Date_Last_Modified,recorduuid,voided",
       ("SiteCode", "PatientPK", "VisitID"), parents=CT_PARENTS_ID, write_partitions=50,
       select=date_casts("VisitDate", "BookingDate")),
    ct("p09", "depression_screening", "DepressionScreeningExtract", "CT_DepressionScreening",
       "ID,PatientID,PatientPK,SiteCode,FacilityName,VisitID,VisitDate,Emr,Project,PHQ9_1,PHQ9_2,PHQ9_3,PHQ9_4,PHQ9_5,"
       "PHQ9_6,PHQ9_7,PHQ9_8,PHQ9_9,PHQ_9_rating,DepressionAssesmentScore,Date_Created,Date_Last_Modified,recorduuid,"
       "voided",
       ("SiteCode", "PatientPK", "VisitID"), parents=CT_PARENTS_ID, write_partitions=50),
    ct("p10", "drug_alcohol_screening", "DrugAlcoholScreeningExtract", "CT_DrugAlcoholScreening",
       "ID,PatientID,PatientPK,SiteCode,FacilityName,VisitID,VisitDate,Emr,Project,DrinkingAlcohol,Smoking,DrugUse,"
       "Date_Created,Date_Last_Modified",
       ("SiteCode", "PatientPK", "VisitID"), write_partitions=50,
       rules=(rc("DrinkingAlcohol", V.NEVER_OR_OTHER), rc("Smoking", V.NEVER_OR_OTHER))),
    ct("p11", "enhanced_adherence_counselling", "EnhancedAdherenceCounsellingExtract",
       "CT_EnhancedAdherenceCounselling",
       "ID,PatientID,PatientPK,SiteCode,FacilityName,VisitID,VisitDate,Emr,Project,SessionNumber,DateOfFirstSession,"
       "PillCountAdherence,MMAS4_1,MMAS4_2,MMAS4_3,MMAS4_4,MMSA8_1,MMSA8_2,MMSA8_3,MMSA8_4,MMSAScore,EACRecievedVL,"
       "EACVL,EACVLConcerns,EACVLThoughts,EACWayForward,EACCognitiveBarrier,EACBehaviouralBarrier_1,"
       "EACBehaviouralBarrier_2,EACBehaviouralBarrier_3,EACBehaviouralBarrier_4,EACBehaviouralBarrier_5,"
       "EACEmotionalBarriers_1,EACEmotionalBarriers_2,EACEconBarrier_1,EACEconBarrier_2,EACEconBarrier_3,"
       "EACEconBarrier_4,EACEconBarrier_5,EACEconBarrier_6,EACEconBarrier_7,EACEconBarrier_8,EACReviewImprovement,"
       "EACReviewMissedDoses,EACReviewStrategy,EACReferral,EACReferralApp,EACReferralExperience,EACHomevisit,"
       "EACAdherencePlan,EACFollowupDate,Date_Created,Date_Last_Modified,recorduuid,voided",
       ("SiteCode", "PatientPK", "VisitID"),
       rules=(d("DateOfFirstSession", "1900-01-01"), d("EACFollowupDate", "1900-01-01"))),
    ct("p14", "gbv_screening", "GbvScreeningExtract", "CT_GbvScreening",
       "ID,PatientID,PatientPK,SiteCode,FacilityName,VisitID,VisitDate,Emr,Project,IPV,PhysicalIPV,EmotionalIPV,"
       "SexualIPV,IPVRelationship,Date_Created,Date_Last_Modified,recorduuid,voided",
       ("SiteCode", "PatientPK", "VisitID"), delta_plain_keys=("SiteCode",)),
    ct("p15", "iit_risk_scores", "IITRiskScoresExtract", "CT_IITRiskScores",
       "SiteCode,PatientID,PatientPK,Emr,Project,Voided,Processed,Id,FacilityName,SourceSysUUID,RiskScore,RiskFactors,"
       "RiskDescription,RiskEvaluationDate,Created,Date_Created,Date_Last_Modified,LoadDate",
       ("Id",), where=(PATIENT_GENDER_OK, CODE_OK), parents=(PATIENT_KEYS, FACILITY_CODE), write_partitions=50,
       derived=(("LoadDate", "{as_of}"),),
       notes="PatientID is the CCC number of the patient (the source job resolves the extract's foreign key)"),
    ct("p16", "ipt", "IptExtract", "CT_Ipt",
       "ID,PatientID,PatientPK,SiteCode,FacilityName,VisitID,VisitDate,Emr,Project,OnTBDrugs,OnIPT,EverOnIPT,Cough,"
       "Fever,NoticeableWeightLoss,NightSweats,Lethargy,ICFActionTaken,TestResult,TBClinicalDiagnosis,ContactsInvited,"
       "EvaluatedForIPT,StartAntiTBs,TBRxStartDate,TBScreening,IPTClientWorkUp,StartIPT,IndicationForIPT,Date_Created,"
       "Date_Last_Modified,recorduuid,voided",
       ("SiteCode", "PatientPK", "VisitID"), parents=CT_PARENTS_ID,
       rules=(rc("TBScreening", V.TB_SCREENING_IPT),
              rc("IndicationForIPT", V.IPT_INDICATION))),
    ct("p17", "otz", "OtzExtract", "CT_Otz",
       "ID,PatientID,PatientPK,SiteCode,FacilityName,VisitID,VisitDate,Emr,Project,OTZEnrollmentDate,TransferInStatus,"
       "ModulesPreviouslyCovered,ModulesCompletedToday,SupportGroupInvolvement,Remarks,TransitionAttritionReason,"
       "OutcomeDate,Date_Created,Date_Last_Modified,recorduuid,voided",
       ("SiteCode", "PatientPK", "VisitID"), parents=CT_PARENTS_ID,
       rules=(d("OTZEnrollmentDate", "2012-01-01"), rc("TransferInStatus", V.YES_NO_10),
              rc("SupportGroupInvolvement", V.YES_NO_10))),
    ct("p18", "ovc", "OvcExtract", "CT_Ovc",
       "ID,PatientID,PatientPK,SiteCode,FacilityName,VisitID,VisitDate,Emr,Project,OVCEnrollmentDate,"
       "RelationshipToClient,EnrolledinCPIMS,CPIMSUniqueIdentifier,PartnerOfferingOVCServices,OVCExitReason,ExitDate,"
       "Date_Created,Date_Last_Modified,recorduuid,voided",
       ("SiteCode", "PatientPK", "VisitID"), parents=CT_PARENTS_ID, write_partitions=50),
    ct("p19", "patient_baselines", "PatientBaselinesExtract", "CT_PatientBaselines",
       "ID,PatientID,PatientPK,SiteCode,bCD4,bCD4Date,bWHO,bWHODate,eCD4,eCD4Date,eWHO,eWHODate,lastWHO,lastWHODate,"
       "lastCD4,lastCD4Date,m12CD4,m12CD4Date,m6CD4,m6CD4Date,Emr,Project,bWAB,bWABDate,eWAB,eWABDate,lastWAB,"
       "lastWABDate,Date_Created,Date_Last_Modified,recorduuid,voided",
       ("SiteCode", "PatientPK"), write_partitions=50,
       latest=Latest(("SiteCode", "PatientPK", "voided"), ("Created",), stage="joined"),
       rules=(num("bCD4", lo=0), d("bWHODate", "1980-01-01"), d("bCD4Date", "1980-01-01"))),
    ct("p20", "patient_labs", "PatientLaboratoryExtract", "CT_PatientLabs",
       "ID,PatientID,PatientPk,SiteCode,FacilityName,VisitID,OrderedbyDate,ReportedbyDate,TestName,EnrollmentTest,"
       "TestResult,Emr,Project,DateSampleTaken,SampleType,reason,Date_Created,Date_Last_Modified,recorduuid,voided",
       ("SiteCode", "PatientPK", "VisitID"), where=(GENDER_OK,), parents=CT_PARENTS_ID, derived=(("FormID", "ID"),),
       latest=Latest(("SiteCode", "PatientPK", "TestResult", "TestName", "OrderedbyDate", "voided"),
                     ("FormID", "cast(Created as date)"), stage="joined"),
       rules=(d("ReportedbyDate", "1900-01-01"), d("OrderedbyDate", "1900-01-01"), rc("Emr", V.EMR_NAMES),
              rule("TestResult", "negative", label="Viral Load")),
       lookups=(Lookup("TestName", "lkp_test_name", case_insensitive=True),)),
    ct("p21", "patient_pharmacy", "PatientPharmacyExtract", "CT_PatientPharmacy",
       "ID,PatientID,SiteCode,FacilityName,PatientPK,VisitID,Drug,DispenseDate,Duration,ExpectedReturn,TreatmentType,"
       "PeriodTaken,ProphylaxisType,Emr,Project,RegimenLine,RegimenChangedSwitched,RegimenChangeSwitchReason,"
       "StopRegimenReason,StopRegimenDate,Date_Created,Date_Last_Modified,recorduuid,voided",
       ("SiteCode", "PatientPK", "VisitID"), write_partitions=50,
       rules=(num("Duration", lo=0), d("ExpectedReturn", "1900-01-01", hi=None), rule("PeriodTaken", "number", lo=0, lo_open=True, fill=999),
              rc("Emr", V.EMR_NAMES), rc("Project", V.PROJECT_NAMES)),
       lookups=(Lookup("Drug", "lkp_regimen"), Lookup("TreatmentType", "lkp_treatment_type"),
                Lookup("ProphylaxisType", "lkp_prophylaxis_type")),
       notes="valid Duration / PeriodTaken values are kept; the TOP 20 debug limit of the source text is off"),
    ct("p22", "patient_status", "PatientStatusExtract", "CT_PatientStatus",
       "PatientID,SiteCode,FacilityName,ExitDescription,ExitDate,ExitReason,PatientPK,Emr,Project,TOVerified,"
       "TOVerifiedDate,ReEnrollmentDate,DeathDate,EffectiveDiscontinuationDate,ReasonForDeath,SpecificDeathReason,"
       "Date_Created,Date_Last_Modified,recorduuid,voided",
       ("SiteCode", "PatientPK", ("cast(ExitDate as date)", "ExitDate")), write_partitions=50,
       latest=Latest(("PatientPK", "SiteCode", "ExitDate", "voided"), ("ID", "cast(Created as date)"),
                     join_keys=("PatientPK", "SiteCode", "ExitDate"), stage="joined"),
       select=date_casts("DeathDate"),
       rules=(d("ExitDate", "2004-01-01"), rc("Emr", V.EMR_AMRS_ONLY), rc("Project", V.PROJECT_NAMES_STATUS))),
    ct("p23", "patient_visits", "PatientVisitExtract", "CT_PatientVisits",
       "PatientID,FacilityName,SiteCode,PatientPK,VisitID,VisitDate,SERVICE,VisitType,WHOStage,WABStage,Pregnant,LMP,"
       "EDD,Height,Weight,BP,OI,OIDate,Adherence,AdherenceCategory,FamilyPlanningMethod,PwP,GestationAge,"
       "NextAppointmentDate,Emr,Project,DifferentiatedCare,StabilityAssessment,KeyPopulationType,PopulationType,"
       "VisitBy,Temp,PulseRate,RespiratoryRate,OxygenSaturation,Muac,NutritionalStatus,EverHadMenses,Breastfeeding,"
       "Menopausal,NoFPReason,ProphylaxisUsed,CTXAdherence,CurrentRegimen,HCWConcern,TCAReason,ClinicalNotes,ZScore,"
       "ZScoreAbsolute,RefillDate,PaedsDisclosure,Date_Created,Date_Last_Modified,recorduuid,voided",
       ("PatientPK", "SiteCode", "VisitID"), write_partitions=50,
       latest=Latest(("SiteCode", "PatientPK", "VisitID", "VisitDate", "voided"), ("ID", "Created"), stage="joined"),
       rules=(d("OIDate", "2000-01-01"), num("Weight", 0, 200), rule("Weight", "blank"), num("Height", 0, 259),
              rule("Height", "blank"), rc("Pregnant", V.PREGNANT_VISIT), rc("StabilityAssessment", V.STABILITY),
              rc("DifferentiatedCare", V.DIFFERENTIATED_CARE), d("VisitDate", "1980-01-01"),
              d("NextAppointmentDate", "1980-01-01", hi="today+1y")),
       lookups=(Lookup("FamilyPlanningMethod", "lkp_family_planning_method"), Lookup("PwP", "lkp_pwp"))),
    ct("p24", "patients", "PatientExtract", "CT_Patient",
       "ID,PatientID,PatientPK,SiteCode,FacilityName,Gender,DOB,RegistrationDate,RegistrationAtCCC,RegistrationAtPMTCT,"
       "RegistrationAtTBClinic,PatientSource,Region,District,Village,ContactRelation,LastVisit,MaritalStatus,"
       "EducationLevel,DateConfirmedHIVPositive,PreviousARTExposure,PreviousARTStartDate,Emr,Project,Orphan,Inschool,"
       "PatientType,PopulationType,KeyPopulationType,PatientResidentCounty,PatientResidentSubCounty,"
       "PatientResidentLocation,PatientResidentSubLocation,PatientResidentWard,PatientResidentVillage,TransferInDate,"
       "Occupation,NUPI,Pkv,Date_Created,Date_Last_Modified,recorduuid,voided",
       ("SiteCode", "PatientPK"), write_partitions=50,
       parents=(FACILITY,),
       derived=(("PatientID", "PatientCccNumber"), ("PatientPK", "PatientPID")),
       where=("Gender IS NOT NULL", GENDER_OK, CODE_OK),
       latest=Latest(("PatientPK", "SiteCode"), ("ID", "cast(Created as date)"), stage="joined", over=(FACILITY_ANY,)),
       nulls=("PopulationType", "KeyPopulationType"),
       rules=(d("DOB", "1910-01-01"),
              *[d(c, "1980-01-01") for c in ("RegistrationDate", "RegistrationAtCCC", "RegistrationAtPMTCT",
                                             "RegistrationAtTBClinic", "PreviousARTStartDate", "LastVisit",
                                             "DateConfirmedHIVPositive", "TransferInDate")]),
       lookups=(Lookup("MaritalStatus", "lkp_MaritalStatus", "Source_MaritalStatus", "Target_MaritalStatus"),
                Lookup("EducationLevel", "Lkp_EducationLevel", "SourceEducationLevel", "TargetEducationLevel"),
                Lookup("PreviousARTExposure", "lkp_RegimenLineMap", "Source_Regimen", "Target_Regimen"),
                Lookup("PatientSource", "lkp_patient_source")),
       hashes=HASH_ID_PK + (("NUPI", "NUPIHash"),)),
]
