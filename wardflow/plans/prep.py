"""PrEP load specs.

Forms carry PatientPk/SiteCode; PrepPatients is an existence check.  Most
forms apply two latest rules at once (newest by creation day and newest by
extraction day), both over the unfiltered form.  Text fields use '' for
missing values, so many columns get blank -> NULL.

FIXED VALUES: the source and target table names, the output column lists (in
order), key columns, date bounds and numeric thresholds below are the load
jobs' contracts and must equal them; they are stated as given.
"""

from wardflow.plans import vocab as V
from wardflow.plans.ct import rc
from wardflow.plans.hts import to_null_before
from wardflow.plans.spec import Latest, LoadSpec, Parent, cols, rule, rules_of

PREP_PATIENTS = Parent("PrepPatients", (("SiteCode", "SiteCode"), ("PatientPk", "PatientPk")), kind="semi")
PREP_PATIENTS_NO = Parent("PrepPatients", (("SiteCode", "SiteCode"), ("PatientPk", "PatientPk"),
                                           ("PrepNumber", "PrepNumber")), kind="semi")
PK_SITE = ("PatientPk", "SiteCode")
CREATED = ("ID", "cast(Created as date)")
EXTRACTED = ("ID", "cast(DateExtracted as date)")
HASH_PREP = (("PrepNumber", "PrepNumberHash"), ("PatientPk", "PatientPKHash"))


def prep(pid, name, source, target, columns, delta=PK_SITE, parents=(PREP_PATIENTS,), **kw):
    kw.setdefault("hashes", HASH_PREP)
    kw.setdefault("write_partitions", "config")
    return LoadSpec(name=f"{pid}_{name}", source=source, target=target, columns=cols(columns),
                    delta_keys=tuple(delta), parents=parents, module="prep", **kw)


def text_date_to_null(col, lo="1980-01-01"):
    return to_null_before(col, lo, text=True, blank=True)


SPECS = [
    prep("p45", "adverse_events", "PrepAdverseEvents", "PrEP_AdverseEvent",
         "Id,RefId,Created,PatientPk,SiteCode,Emr,Project,Processed,QueueId,Status,StatusDate,DateExtracted,"
         "FacilityId,FacilityName,PrepNumber,AdverseEvent,AdverseEventStartDate,AdverseEventEndDate,Severity,"
         "VisitDate,AdverseEventActionTaken,AdverseEventClinicalOutcome,AdverseEventIsPregnant,AdverseEventCause,"
         "AdverseEventRegimen,Date_Created,Date_Last_Modified,RecordUUID",
         parents=(PREP_PATIENTS_NO,), latest=Latest(PK_SITE, CREATED),
         rules=rules_of("blank", ["AdverseEventRegimen", "AdverseEventIsPregnant", "AdverseEventClinicalOutcome",
                                  "AdverseEventActionTaken", "Severity", "AdverseEventEndDate",
                                  "AdverseEventStartDate", "AdverseEvent"])),
    prep("p46", "behaviour_risk", "PrepBehaviourRisks", "PrEP_BehaviourRisk",
         "RefId,Created,PatientPk,SiteCode,Emr,Project,Processed,QueueId,Status,StatusDate,DateExtracted,FacilityId,"
         "FacilityName,PrepNumber,HtsNumber,VisitDate,VisitID,SexPartnerHIVStatus,IsHIVPositivePartnerCurrentonART,"
         "IsPartnerHighrisk,PartnerARTRisk,ClientAssessments,ClientRisk,ClientWillingToTakePrep,PrEPDeclineReason,"
         "RiskReductionEducationOffered,ReferralToOtherPrevServices,FirstEstablishPartnerStatus,PartnerEnrolledtoCCC,"
         "HIVPartnerCCCnumber,HIVPartnerARTStartDate,MonthsknownHIVSerodiscordant,SexWithoutCondom,"
         "NumberofchildrenWithPartner,Date_Created,Date_Last_Modified,RecordUUID",
         delta=("PatientPk", "SiteCode", "VisitID"),
         latest=Latest(PK_SITE, (CREATED, ("cast(DateExtracted as date)",))),
         rules=rules_of("blank", ["NumberofchildrenWithPartner", "SexWithoutCondom", "MonthsknownHIVSerodiscordant",
                                  "HIVPartnerARTStartDate", "PartnerEnrolledtoCCC", "ReferralToOtherPrevServices",
                                  "RiskReductionEducationOffered", "PrEPDeclineReason", "ClientWillingToTakePrep",
                                  "ClientRisk", "IsPartnerHighrisk", "IsHIVPositivePartnerCurrentonART",
                                  "SexPartnerHIVStatus"])),
    prep("p47", "care_termination", "PrepCareTerminations", "PrEP_CareTermination",
         "ID,RefId,Created,PatientPk,SiteCode,Emr,Project,Processed,QueueId,Status,StatusDate,DateExtracted,"
         "FacilityId,FacilityName,PrepNumber,HtsNumber,ExitDate,ExitReason,DateOfLastPrepDose,Date_Created,"
         "Date_Last_Modified,RecordUUID",
         latest=Latest(PK_SITE, (CREATED, EXTRACTED)),
         rules=rules_of("blank", ["DateOfLastPrepDose", "ExitReason"])),
    prep("p48", "lab", "PrepLabs", "PrEP_Lab",
         "RefId,Created,PatientPk,SiteCode,Emr,Project,Processed,QueueId,Status,StatusDate,DateExtracted,FacilityId,"
         "FacilityName,PrepNumber,HtsNumber,VisitID,TestName,TestResult,SampleDate,TestResultDate,Reason,Date_Created,"
         "Date_Last_Modified,RecordUUID",
         delta=("PatientPk", "SiteCode", "PrepNumber"), parents=(PREP_PATIENTS_NO,),
         latest=Latest(("PatientPk", "SiteCode", "PrepNumber"), CREATED, join_keys=PK_SITE),
         rules=rules_of("blank", ["Reason", "SampleDate"])),
    prep("p49", "patient", "PrepPatients", "PrEP_Patient",
         "ID,RefId,Created,PatientPk,SiteCode,Emr,Project,Processed,QueueId,Status,StatusDate,DateExtracted,"
         "FacilityId,FacilityName,PrepNumber,HtsNumber,PrepEnrollmentDate,Sex,DateofBirth,CountyofBirth,County,"
         "SubCounty,Location,LandMark,Ward,ClientType,ReferralPoint,MaritalStatus,Inschool,PopulationType,"
         "KeyPopulationType,Refferedfrom,TransferIn,TransferInDate,TransferFromFacility,DatefirstinitiatedinPrepCare,"
         "DateStartedPrEPattransferringfacility,ClientPreviouslyonPrep,PrevPrepReg,DateLastUsedPrev,Date_Created,"
         "Date_Last_Modified,RecordUUID",
         parents=(), distinct=False, latest=Latest(PK_SITE, CREATED), nulls=("PopulationType", "KeyPopulationType"),
         rules=(*rules_of("blank", ["DateLastUsedPrev", "PrevPrepReg", "ClientPreviouslyonPrep",
                                    "DateStartedPrEPattransferringfacility", "TransferFromFacility", "TransferInDate",
                                    "Refferedfrom", "PopulationType", "ReferralPoint", "ClientType", "Ward",
                                    "LandMark", "SubCounty", "CountyofBirth", "Sex"]),
                rc("KeyPopulationType", V.KEY_POPULATION), rc("Inschool", V.IN_SCHOOL_12),
                rc("MaritalStatus", V.PREP_MARITAL), rc("County", V.PREP_COUNTY))),
    prep("p50", "pharmacy", "PrepPharmacys", "PrEP_Pharmacy",
         "ID,RefId,Created,PatientPk,SiteCode,Emr,Project,Processed,QueueId,Status,StatusDate,DateExtracted,"
         "FacilityId,FacilityName,PrepNumber,HtsNumber,VisitID,RegimenPrescribed,DispenseDate,Duration,Date_Created,"
         "Date_Last_Modified,RecordUUID",
         delta=("PatientPk", "SiteCode", "VisitID"), parents=(),
         latest=Latest(PK_SITE, (CREATED, EXTRACTED)),
         rules=(rule("Duration", "cap", hi=12), text_date_to_null("DispenseDate"), rule("RegimenPrescribed", "blank"))),
    prep("p51", "visits", "PrepVisits", "PrEP_Visits",
         "RefId,Created,PatientPk,SiteCode,Emr,Project,Processed,QueueId,Status,StatusDate,DateExtracted,FacilityId,"
         "FacilityName,PrepNumber,HtsNumber,VisitDate,VisitID,BloodPressure,Temperature,Weight,Height,BMI,"
         "STIScreening,STISymptoms,STITreated,Circumcised,VMMCReferral,LMP,MenopausalStatus,PregnantAtThisVisit,EDD,"
         "PlanningToGetPregnant,PregnancyPlanned,PregnancyEnded,PregnancyEndDate,PregnancyOutcome,BirthDefects,"
         "Breastfeeding,FamilyPlanningStatus,FPMethods,AdherenceDone,AdherenceOutcome,AdherenceReasons,"
         "SymptomsAcuteHIV,ContraindicationsPrep,PrepTreatmentPlan,PrepPrescribed,RegimenPrescribed,MonthsPrescribed,"
         "CondomsIssued,Tobegivennextappointment,Reasonfornotgivingnextappointment,HepatitisBPositiveResult,"
         "HepatitisCPositiveResult,VaccinationForHepBStarted,TreatedForHepB,VaccinationForHepCStarted,"
         "TreatedForHepC,NextAppointment,ClinicalNotes,Date_Created,Date_Last_Modified,RecordUUID",
         delta=("PatientPk", "SiteCode", "VisitID"), parents=(),
         latest=Latest(PK_SITE, (CREATED, EXTRACTED)),
         rules=(*rules_of("blank", ["ClinicalNotes", "TreatedForHepC", "VaccinationForHepCStarted",
                                    "VaccinationForHepBStarted", "HepatitisCPositiveResult",
                                    "HepatitisBPositiveResult", "Reasonfornotgivingnextappointment",
                                    "Tobegivennextappointment", "CondomsIssued", "RegimenPrescribed",
                                    "PrepPrescribed", "PrepTreatmentPlan", "ContraindicationsPrep",
                                    "SymptomsAcuteHIV", "AdherenceReasons", "AdherenceOutcome", "AdherenceDone",
                                    "FPMethods", "FamilyPlanningStatus", "Breastfeeding", "BirthDefects",
                                    "PregnancyOutcome", "PregnancyEndDate", "PregnancyEnded", "PregnancyPlanned",
                                    "PlanningToGetPregnant", "EDD", "PregnantAtThisVisit", "MenopausalStatus", "LMP",
                                    "VMMCReferral", "Circumcised", "STITreated", "STISymptoms", "STIScreening",
                                    "BMI", "Height", "Weight", "BloodPressure", "TreatedForHepB"]),
                rule("MonthsPrescribed", "cap", hi=12), text_date_to_null("VisitDate"),
                text_date_to_null("NextAppointment"))),
]
