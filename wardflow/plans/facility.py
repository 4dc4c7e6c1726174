"""Facility master and upload-manifest load specs.

FIXED VALUES: the source and target table names, the output column lists (in
order), key columns, date bounds and numeric thresholds below are the load
jobs' contracts and must equal them; they are stated as given.
"""

from wardflow.plans.spec import LoadSpec, cols

SPECS = [
    LoadSpec(name="p12_emr_sites", source="ALL_EMRSites", target="ALL_EMRSites", module="facility",
             columns=cols("MFL_Code,Facility_Name,County,SubCounty,Owner,Latitude,Longitude,SDP,SDP_Agency,"
                          "Implementation,EMR,EMR_Status,HTS_Use,HTS_Deployment,HTS_Status,IL_Status,Registration_IE,"
                          "Phamarmacy_IE,mlab,Ushauri,Nishauri,Appointment_Management_IE,OVC,OTZ,PrEP,_3PM,AIR,KP,MCH,"
                          "TB,Lab_Manifest,Comments,Project"),
             nulls=("IL_Status", "Registration_IE", "Phamarmacy_IE", "Appointment_Management_IE", "_3PM", "TB"),
             where=("MFL_Code <> ''",), delta_keys=("MFL_Code",)),
    LoadSpec(name="p13_facility_manifest", source="FacilityManifest", target="CT_FacilityManifest", module="facility",
             columns=cols("ID,Voided,Processed,SiteCode,PatientCount,DateRecieved,Name,EmrName,EmrSetup,UploadMode,"
                          "Start,End,Tag"),
             delta_keys=("ID",), write_partitions=50),
]
