"""Mother-and-child load specs.

Forms carry PatientPk/SiteCode; the Facilities table is joined on the form's
FacilityId (an existence check unless the text takes the facility's name or
code).  The latest rule runs over the form alone.

FIXED VALUES: the source and target table names, the output column lists (in
order), key columns, date bounds and numeric thresholds below are the load
jobs' contracts and must equal them; they are stated as given.
"""

from wardflow.plans.spec import Latest, LoadSpec, Parent, cols, date_casts

FACILITIES = Parent("Facilities", (("FacilityId", "Id"),), kind="semi")
FACILITIES_NAME = Parent("Facilities", (("FacilityId", "Id"),), columns=(("Name", "FacilityName"),))
FACILITIES_CODE = Parent("Facilities", (("FacilityId", "Id"),), columns=(("SiteCode", "SiteCode"),))
EXTRACTED_DAY = ("ID", "cast(DateExtracted as date)")
PK_SITE = ("PatientPk", "SiteCode")


# columns the select lists cast to dates
DATE_CASTS = {
    "p33": ("VisitDate", "NextAppointmentANC"),
    "p35": ("DateExtracted", "RegistrationAtCWC", "RegistrationAtHEI", "ARTStartDateMother"),
    "p36": ("DateExtracted", "VisitDate", "NextAppointment"),
    "p37": ("DateExtracted", "EnrollmentDateAtMnch", "HIVTestDate", "PartnerHIVTestDate"),
    "p44": ("DateExtracted", "VisitDate", "DeliveryDate", "NextAppointmentPNC"),
}


def mnch(pid, name, source, target, columns, delta=PK_SITE, id_col="PatientMnchID", parents=(FACILITIES,),
         latest_keys=PK_SITE, maxes=EXTRACTED_DAY, **kw):
    kw.setdefault("hashes", ((id_col, f"{id_col}Hash"), ("PatientPk", "PatientPKHash")))
    kw.setdefault("write_partitions", "config")
    if pid in DATE_CASTS:
        kw["select"] = date_casts(*DATE_CASTS[pid])
    latest = kw.pop("latest", Latest(latest_keys, maxes) if latest_keys else None)
    return LoadSpec(name=f"{pid}_{name}", source=source, target=target, columns=cols(columns),
                    delta_keys=tuple(delta), parents=parents, latest=latest, module="mnch", **kw)


SPECS = [
    mnch("p33", "anc_visits", "AncVisits", "MNCH_AncVisits",
         "PatientMnchID,ANCClinicNumber,PatientPk,SiteCode,FacilityName,EMR,Project,VisitID,VisitDate,ANCVisitNo,"
         "GestationWeeks,Height,Weight,Temp,PulseRate,RespiratoryRate,OxygenSaturation,MUAC,BP,BreastExam,"
         "AntenatalExercises,FGM,FGMComplications,Haemoglobin,DiabetesTest,TBScreening,CACxScreen,CACxScreenMethod,"
         "WHOStaging,VLSampleTaken,VLDate,VLResult,SyphilisTreatment,HIVStatusBeforeANC,HIVTestingDone,HIVTestType,"
         "HIVTest1,HIVTest1Result,HIVTest2,HIVTest2Result,HIVTestFinalResult,SyphilisTestDone,SyphilisTestType,"
         "SyphilisTestResults,SyphilisTreated,MotherProphylaxisGiven,MotherGivenHAART,AZTBabyDispense,NVPBabyDispense,"
         "ChronicIllness,CounselledOn,PartnerHIVTestingANC,PartnerHIVStatusANC,PostParturmFP,Deworming,"
         "MalariaProphylaxis,TetanusDose,IronSupplementsGiven,ReceivedMosquitoNet,PreventiveServices,"
         "UrinalysisVariables,ReferredFrom,ReferredTo,ReferralReasons,NextAppointmentANC,ClinicalNotes,"
         "Date_Last_Modified,RecordUUID",
         delta=("PatientPk", "SiteCode", "VisitID", "ANCClinicNumber"), parents=(FACILITIES_CODE,),
         latest_keys=("PatientPk", "SiteCode", "VisitDate")),
    mnch("p34", "arts", "MnchArts", "MNCH_Arts",
         "PatientPk,SiteCode,Emr,Project,Processed,QueueId,Status,StatusDate,DateExtracted,PatientMnchID,PatientHeiID,"
         "FacilityName,RegistrationAtCCC,StartARTDate,StartRegimen,StartRegimenLine,StatusAtCCC,LastARTDate,"
         "LastRegimen,LastRegimenLine,Date_Created,Date_Last_Modified,FacilityReceivingARTCare,RecordUUID"),
    mnch("p35", "cwc_enrolments", "CwcEnrolments", "MNCH_CwcEnrolments",
         "PatientIDCWC,HEIID,PatientPk,SiteCode,EMR,FacilityName,Project,DateExtracted,PKV,MothersPkv,"
         "RegistrationAtCWC,RegistrationAtHEI,VisitID,Gestation,BirthWeight,BirthLength,BirthOrder,BirthType,"
         "PlaceOfDelivery,ModeOfDelivery,SpecialNeeds,SpecialCare,HEI,MotherAlive,MothersCCCNo,TransferIn,"
         "TransferInDate,TransferredFrom,HEIDate,NVP,BreastFeeding,ReferredFrom,ARTMother,ARTRegimenMother,"
         "ARTStartDateMother,Date_Created,Date_Last_Modified,RecordUUID",
         parents=(FACILITIES_NAME,),
         hashes=(("MothersPkv", "MothersPkvHash"), ("MothersCCCNo", "MothersCCCNoHash"),
                 ("PatientPk", "PatientPKHash"))),
    mnch("p36", "cwc_visits", "CwcVisits", "MNCH_CwcVisits",
         "PatientMnchID,PatientPk,SiteCode,FacilityName,EMR,Project,DateExtracted,VisitDate,VisitID,Height,Weight,"
         "Temp,PulseRate,RespiratoryRate,OxygenSaturation,MUAC,WeightCategory,Stunted,InfantFeeding,MedicationGiven,"
         "TBAssessment,MNPsSupplementation,Immunization,DangerSigns,Milestones,VitaminA,Disability,"
         "ReceivedMosquitoNet,Dewormed,ReferredFrom,ReferredTo,ReferralReasons,FollowUP,NextAppointment,"
         "Date_Last_Modified,ZScore,ZScoreAbsolute,HeightLength,Refferred,RevisitThisYear,RecordUUID",
         latest=Latest(("PatientPk", "SiteCode", "VisitDate"), EXTRACTED_DAY, join_keys=("PatientPk", "SiteCode")),
         notes="the latest rule groups by VisitDate but joins on (PatientPk, SiteCode)"),
    mnch("p37", "enrolments", "MnchEnrolments", "MNCH_Enrolments",
         "PatientMnchID,PatientPk,SiteCode,FacilityName,EMR,Project,DateExtracted,ServiceType,EnrollmentDateAtMnch,"
         "MnchNumber,FirstVisitAnc,Parity,Gravidae,LMP,EDDFromLMP,HIVStatusBeforeANC,HIVTestDate,PartnerHIVStatus,"
         "PartnerHIVTestDate,BloodGroup,StatusAtMnch,Date_Last_Modified,RecordUUID"),
    mnch("p38", "heis", "Heis", "MNCH_HEIs",
         "PatientPk,SiteCode,Emr,Project,Processed,QueueId,Status,StatusDate,FacilityId,FacilityName,PatientMnchID,"
         "DNAPCR1Date,DNAPCR2Date,DNAPCR3Date,ConfirmatoryPCRDate,BasellineVLDate,FinalyAntibodyDate,DNAPCR1,DNAPCR2,"
         "DNAPCR3,ConfirmatoryPCR,BasellineVL,FinalyAntibody,HEIExitDate,HEIHIVStatus,HEIExitCritearia,Date_Created,"
         "Date_Last_Modified,RecordUUID"),
    mnch("p39", "immunization", "MnchImmunization", "MNCH_Immunization",
         "Id,RefId,PatientPk,SiteCode,Emr,Project,DateExtracted,FacilityId,FacilityName,PatientMnchID,BCG,OPVatBirth,"
         "OPV1,OPV2,OPV3,IPV,DPTHepBHIB1,DPTHepBHIB2,DPTHepBHIB3,PCV101,PCV102,PCV103,ROTA1,MeaslesReubella1,"
         "YellowFever,MeaslesReubella2,MeaslesAt6Months,ROTA2,DateOfNextVisit,BCGScarChecked,DateChecked,"
         "DateBCGrepeated,VitaminAAt6Months,VitaminAAt1Yr,VitaminAAt18Months,VitaminAAt2Years,VitaminAAt2To5Years,"
         "FullyImmunizedChild,RecordUUID",
         delta=("SiteCode", "PatientPk", "PatientMnchID"), delta_plain_keys=("Id",), parents=(), hashes=(),
         write_partitions=50),
    mnch("p40", "labs", "MnchLabs", "MNCH_Labs",
         "PatientPk,SiteCode,Emr,Project,Processed,QueueId,Status,StatusDate,PatientMNCH_ID,FacilityName,"
         "SatelliteName,VisitID,OrderedbyDate,ReportedbyDate,TestName,TestResult,LabReason,Date_Last_Modified,"
         "RecordUUID",
         delta=("PatientPk", "SiteCode", "VisitID", "TestName", "TestResult"), id_col="PatientMNCH_ID",
         latest_keys=("PatientPk", "SiteCode", "OrderedbyDate"), maxes=("ID", "DateExtracted")),
    mnch("p41", "mat_visits", "MatVisits", "MNCH_MatVisits",
         "PatientPk,SiteCode,Emr,Project,Processed,QueueId,Status,StatusDate,DateExtracted,FacilityId,PatientMnchID,"
         "FacilityName,VisitID,VisitDate,AdmissionNumber,ANCVisits,DateOfDelivery,DurationOfDelivery,"
         "GestationAtBirth,ModeOfDelivery,PlacentaComplete,UterotonicGiven,VaginalExamination,BloodLoss,"
         "BloodLossVisual,ConditonAfterDelivery,MaternalDeath,DeliveryComplications,NoBabiesDelivered,"
         "BabyBirthNumber,SexBaby,BirthWeight,BirthOutcome,BirthWithDeformity,TetracyclineGiven,InitiatedBF,"
         "ApgarScore1,ApgarScore5,ApgarScore10,KangarooCare,ChlorhexidineApplied,VitaminKGiven,StatusBabyDischarge,"
         "MotherDischargeDate,SyphilisTestResults,HIVStatusLastANC,HIVTestingDone,HIVTest1,HIV1Results,HIVTest2,"
         "HIV2Results,HIVTestFinalResult,OnARTANC,BabyGivenProphylaxis,MotherGivenCTX,PartnerHIVTestingMAT,"
         "PartnerHIVStatusMAT,CounselledOn,ReferredFrom,ReferredTo,ClinicalNotes,EDD,LMP,MaternalDeathAudited,"
         "OnARTMat,ReferralReason,RecordUUID"),
    mnch("p42", "mother_baby_pairs", "MotherBabyPairs", "MNCH_MotherBabyPairs",
         "PatientIDCCC,PatientPk,BabyPatientPK,MotherPatientPK,BabyPatientMncHeiID,MotherPatientMncHeiID,SiteCode,"
         "FacilityName,EMR,Project,Date_Last_Modified,RecordUUID",
         parents=(FACILITIES_NAME,),
         hashes=(("MotherPatientMncHeiID", "MotherPatientMncHeiIDHash"), ("PatientPk", "PatientPKHash"),
                 ("MotherPatientPK", "MotherPatientPKHash"), ("BabyPatientPK", "BabyPatientPKHash"))),
    mnch("p43", "patients", "MnchPatients", "MNCH_Patient",
         "PatientPk,SiteCode,Emr,Project,DateExtracted,FacilityName,Pkv,PatientMnchID,PatientHeiID,Gender,DOB,"
         "FirstEnrollmentAtMnch,Occupation,MaritalStatus,EducationLevel,PatientResidentCounty,"
         "PatientResidentSubCounty,PatientResidentWard,InSchool,Date_Created,Date_Last_Modified,NUPI,RecordUUID",
         hashes=(("PatientMnchID", "PatientMnchIDHash"), ("NUPI", "NUPIHash"), ("PatientPk", "PatientPKHash")),
         notes="Voided NULL->0 applies only where the source has Voided (it is not in this text)"),
    mnch("p44", "pnc_visits", "PncVisits", "MNCH_PncVisits",
         "PatientMnchID,PatientPk,PNCRegisterNumber,SiteCode,EMR,FacilityName,Project,DateExtracted,VisitID,VisitDate,"
         "PNCVisitNo,DeliveryDate,ModeOfDelivery,PlaceOfDelivery,Height,Weight,Temp,PulseRate,RespiratoryRate,"
         "OxygenSaturation,MUAC,BP,BreastExam,GeneralCondition,HasPallor,Pallor,Breast,PPH,CSScar,UterusInvolution,"
         "Episiotomy,Lochia,Fistula,MaternalComplications,TBScreening,ClientScreenedCACx,CACxScreenMethod,"
         "CACxScreenResults,PriorHIVStatus,HIVTestingDone,HIVTest1,HIVTest1Result,HIVTest2,HIVTest2Result,"
         "HIVTestFinalResult,InfantProphylaxisGiven,MotherProphylaxisGiven,CoupleCounselled,PartnerHIVTestingPNC,"
         "PartnerHIVResultPNC,CounselledOnFP,ReceivedFP,HaematinicsGiven,DeliveryOutcome,BabyConditon,BabyFeeding,"
         "UmbilicalCord,Immunization,InfantFeeding,PreventiveServices,ReferredFrom,ReferredTo,NextAppointmentPNC,"
         "ClinicalNotes,Date_Last_Modified,InfactCameForHAART,MotherCameForHIVTest,MotherGivenHAART,VisitTimingBaby,"
         "VisitTimingMother,RecordUUID",
         parents=(FACILITIES_NAME,), latest_keys=("SiteCode", "PatientPk", "VisitDate", "VisitID")),
]
