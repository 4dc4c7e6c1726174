"""HIV-testing load specs.

Forms carry SiteCode/PatientPk themselves; the Clients table is only an
existence check (written as a semi join).  Several HTS rules null out invalid
values instead of writing sentinels.

FIXED VALUES: the source and target table names, the output column lists (in
order), key columns, date bounds and numeric thresholds below are the load
jobs' contracts and must equal them; they are stated as given.
"""

from wardflow.plans import vocab as V
from wardflow.plans.ct import rc
from wardflow.plans.spec import Latest, LoadSpec, Lookup, Parent, cols, rule, rules_of

CLIENTS = Parent("Clients", (("PatientPk", "PatientPk"), ("SiteCode", "SiteCode")), kind="semi")
HASH_HTS = (("HtsNumber", "HtsNumberHash"), ("PatientPk", "PatientPKHash"))
EXTRACTED_CUTOFF = "DateExtracted > DATE '2019-09-08'"
LATEST_PK_SITE = ("ID", "cast(DateExtracted as date)")


def hts(pid, name, source, target, columns, delta, parents=(CLIENTS,), **kw):
    kw.setdefault("hashes", HASH_HTS)
    kw.setdefault("write_partitions", "config")
    return LoadSpec(name=f"{pid}_{name}", source=source, target=target, columns=cols(columns),
                    delta_keys=tuple(delta), parents=parents, module="hts", **kw)


def to_null_before(col, lo, text=False, blank=False):
    return rule(col, "date", lo=lo, hi=None, fill=None, text=text, blank=blank)


SPECS = [
    hts("p25", "client_linkages", "ClientLinkages", "HTS_ClientLinkages",
        "FacilityName,SiteCode,PatientPk,HtsNumber,Emr,Project,EnrolledFacilityName,ReferralDate,DateEnrolled,"
        "DatePrefferedToBeEnrolled,FacilityReferredTo,HandedOverTo,HandedOverToCadre,ReportedCCCNumber,"
        "ReportedStartARTDate,RecordUUID",
        ("PatientPk", "SiteCode"),
        latest=Latest(("SiteCode", "PatientPk"), LATEST_PK_SITE),
        derived=(("DateEnrolled", "cast(DateEnrolled as date)"),
                 ("FacilityReferredTo", "CASE WHEN FacilityReferredTo = 'Other Facility' THEN NULL "
                                        "ELSE FacilityReferredTo END"),
                 ("ReportedStartARTDate", "CASE WHEN cast(ReportedStartARTDate as date) = DATE '0001-01-01' "
                                          "THEN NULL ELSE cast(ReportedStartARTDate as date) END")),
        where=(EXTRACTED_CUTOFF,),
        group_by=("FacilityName", "SiteCode", "PatientPk", "HtsNumber", "Emr", "Project", "EnrolledFacilityName",
                  "DateEnrolled", "FacilityReferredTo", "HandedOverTo", "HandedOverToCadre", "DateExtracted",
                  "ReportedCCCNumber", "ReportedStartARTDate", "RecordUUID"),
        aggregates=(("ReferralDate", "cast(max(ReferralDate) as date)"),
                    ("DatePrefferedToBeEnrolled", "cast(max(DatePrefferedToBeEnrolled) as date)")),
        rules=(to_null_before("ReferralDate", "1980-01-01"), to_null_before("DateEnrolled", "1980-01-01"),
               to_null_before("DatePrefferedToBeEnrolled", "1980-01-01")),
        notes="ReportedStartARTDate is computed by the scan and now also written"),
    hts("p26", "client_tests", "HtsClientTests", "HTS_ClientTests",
        "FacilityName,SiteCode,PatientPk,Emr,Project,EncounterId,TestDate,EverTestedForHiv,MonthsSinceLastTest,"
        "ClientTestedAs,EntryPoint,TestStrategy,TestResult1,TestResult2,FinalTestResult,PatientGivenResult,"
        "TbScreening,ClientSelfTested,CoupleDiscordant,TestType,Consent,Setting,Approach,HtsRiskCategory,"
        "HtsRiskScore,OtherReferredServices,ReferredForServices,ReferredServices,RecordUUID",
        ("PatientPk", "SiteCode", "EncounterId"), write_partitions=50, hashes=(("PatientPk", "PatientPKHash"),),
        latest=Latest(("SiteCode", "PatientPk", "FinalTestResult", "TestDate", "coalesce(EncounterId, -1)"),
                      LATEST_PK_SITE),
        derived=(("TestResult1", "coalesce(TestResult1, 'empty')"), ("TestResult2", "coalesce(TestResult2, 'empty')")),
        where=("FinalTestResult IS NOT NULL",),
        rules=(rule("EncounterId", "default", value=-1),
               rc("ClientTestedAs", V.HTS_TESTED_AS, None), rc("TbScreening", V.HTS_TB_SCREENING, "Not Done"),
               rc("ClientSelfTested", V.HTS_SELF_TESTED, None), rc("CoupleDiscordant", V.HTS_DISCORDANT, None),
               rc("TestType", V.HTS_TEST_TYPE, None), rc("Consent", V.HTS_CONSENT, None),
               rc("Setting", V.HTS_SETTING, None), rc("Approach", V.HTS_APPROACH, None),
               rule("MonthsSinceLastTest", "cap", hi=1540)),
        lookups=(Lookup("EntryPoint", "lkp_patient_source", default="Empty"),
                 Lookup("TestStrategy", "lkp_htsStrategy", "Source_htsStrategy", "Target_htsStrategy",
                        default="Empty"))),
    hts("p27", "client_tracing", "HtsClientTracing", "HTS_ClientTracing",
        "FacilityName,SiteCode,PatientPk,HtsNumber,Emr,Project,TracingType,TracingDate,TracingOutcome,RecordUUID",
        ("PatientPk", "SiteCode", "HtsNumber", "TracingOutcome"),
        where=("TracingType IS NOT NULL", "TracingOutcome IS NOT NULL")),
    hts("p28", "clients", "Clients", "HTS_clients",
        "HtsNumber,Emr,Project,PatientPk,SiteCode,FacilityName,Dob,Gender,MaritalStatus,KeyPopulationType,"
        "DisabilityType,PatientDisabled,County,SubCounty,Ward,NUPI,HtsRecencyId,Occupation,PriorityPopulationType,"
        "pkv,RecordUUID",
        ("PatientPk", "SiteCode"), parents=(), hashes=(("NUPI", "NUPIHash"), ("PatientPk", "PatientPKHash")),
        latest=Latest(("SiteCode", "PatientPk"), ("ID", "cast(DateCreated as date)")),
        derived=(("Dob", "cast(Dob as date)"), ("Gender", "left(Gender, 1)"),
                 ("KeyPopulationType", "CAST(NULL AS STRING)"),
                 ("DisabilityType", "coalesce(PatientDisabled, '')"),
                 ("PatientDisabled", "coalesce(PatientDisabled, '')")),
        where=(EXTRACTED_CUTOFF,),
        rules=(rule("Dob", "date", lo="1910-01-01", hi="today", fill=None), rc("Gender", V.GENDER_MF),
               rule("PatientDisabled", "present")),
        lookups=(Lookup("MaritalStatus", "lkp_MaritalStatus", "Source_MaritalStatus", "Target_MaritalStatus"),
                 Lookup("DisabilityType", "lkp_htsDisability", "Source_Disability", "Target_Disability"))),
    hts("p29", "eligibility", "HtsEligibilityExtract", "HTS_EligibilityExtract",
        "ID,FacilityName,SiteCode,PatientPk,HtsNumber,Emr,Project,Processed,QueueId,Status,StatusDate,EncounterId,"
        "VisitID,VisitDate,PopulationType,KeyPopulation,PriorityPopulation,Department,PatientType,IsHealthWorker,"
        "RelationshipWithContact,TestedHIVBefore,WhoPerformedTest,ResultOfHIV,DateTestedSelf,StartedOnART,CCCNumber,"
        "EverHadSex,SexuallyActive,NewPartner,PartnerHIVStatus,CoupleDiscordant,MultiplePartners,NumberOfPartners,"
        "AlcoholSex,MoneySex,CondomBurst,UnknownStatusPartner,KnownStatusPartner,Pregnant,BreastfeedingMother,"
        "ExperiencedGBV,ContactWithTBCase,Lethargy,EverOnPrep,CurrentlyOnPrep,EverOnPep,CurrentlyOnPep,EverHadSTI,"
        "CurrentlyHasSTI,EverHadTB,SharedNeedle,NeedleStickInjuries,TraditionalProcedures,"
        "ChildReasonsForIneligibility,EligibleForTest,ReasonsForIneligibility,SpecificReasonForIneligibility,Cough,"
        "DateTestedProvider,Fever,MothersStatus,NightSweats,ReferredForTesting,ResultOfHIVSelf,ScreenedTB,TBStatus,"
        "WeightLoss,AssessmentOutcome,ForcedSex,ReceivedServices,TypeGBV,Disability,DisabilityType,HTSStrategy,"
        "HTSEntryPoint,HIVRiskCategory,ReasonRefferredForTesting,ReasonNotReffered,HtsRiskScore,RecordUUID",
        ("PatientPk", "SiteCode"),
        latest=Latest(("SiteCode", "PatientPk", "EncounterId", "VisitID"),
                      (("ID", "DateCreated"), ("ID", "cast(DateExtracted as date)"))),
        rules=(*rules_of("blank", ["TypeGBV", "ReceivedServices", "ResultOfHIVSelf", "ReasonsForIneligibility",
                                   "ChildReasonsForIneligibility", "PartnerHIVStatus", "RelationshipWithContact"]),
               *[rc(c, V.NO_YES_01) for c in ("WeightLoss", "NightSweats", "Pregnant", "Cough", "IsHealthWorker")],
               rc("PatientType", V.PATIENT_TYPE),
               to_null_before("DateTestedProvider", "1980-01-01"), to_null_before("VisitDate", "2019-01-01"))),
    hts("p30", "partner_notification_services", "HtsPartnerNotificationServices", "HTS_PartnerNotificationServices",
        "ID,FacilityName,SiteCode,PatientPk,HtsNumber,Emr,Project,PartnerPatientPk,KnowledgeOfHivStatus,"
        "PartnerPersonID,CccNumber,IpvScreeningOutcome,ScreenedForIpv,PnsConsent,RelationsipToIndexClient,"
        "LinkedToCare,MaritalStatus,PnsApproach,FacilityLinkedTo,Gender,CurrentlyLivingWithIndexClient,Age,"
        "DateElicited,Dob,LinkDateLinkedToCare,RecordUUID",
        ("PatientPk", "SiteCode", "PartnerPatientPk"),
        rules=(rule("FacilityLinkedTo", "blank"), rc("PnsApproach", V.PNS_APPROACH), rc("LinkedToCare", V.LINKED_YN),
               rc("PnsConsent", V.PNS_CONSENT), rule("ScreenedForIpv", "sentinel", tokens=("N/A",)),
               rule("CccNumber", "blank"), rule("Age", "cap", lo=0, hi=100))),
    hts("p31", "partner_tracing", "HtsPartnerTracings", "HTS_PartnerTracings",
        "FacilityName,SiteCode,PatientPk,HtsNumber,Emr,Project,TraceType,TraceDate,TraceOutcome,BookingDate,"
        "RecordUUID",
        ("PatientPk", "SiteCode", "HtsNumber"),
        latest=Latest(("SiteCode", "PatientPk", "HtsNumber", "TraceType", "TraceDate", "BookingDate", "TraceOutcome"),
                      LATEST_PK_SITE, join_keys=("SiteCode", "PatientPk", "TraceType", "BookingDate")),
        rules=(rule("TraceOutcome", "sentinel", tokens=("null", "NULL")),)),
    hts("p32", "test_kits", "HtsTestKits", "HTS_TestKits",
        "FacilityName,SiteCode,PatientPk,HtsNumber,Emr,Project,EncounterId,TestKitName1,TestKitLotNumber1,"
        "TestKitExpiry1,TestResult1,TestKitName2,TestKitLotNumber2,TestKitExpiry2,TestResult2,RecordUUID",
        ("PatientPk", "SiteCode"),
        latest=Latest(("SiteCode", "PatientPk", "EncounterId", "TestKitName1", "TestResult2", "TestKitLotNumber1"),
                      LATEST_PK_SITE),
        rules=(rule("TestResult2", "sentinel", tokens=("N/A",)), rule("TestKitName2", "blank"),
               rule("TestKitName1", "blank"))),
]
