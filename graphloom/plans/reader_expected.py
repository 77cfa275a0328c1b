"""What the readers give for the stated exports of ``reader_cases``: fixed values.

Rows are (kind, a, b, c, attributes).
"""

EXPECTED: dict[str, list[tuple[str, str, str, str, str]]] = {
    "cmssw": [
        ('edge', 'cmssw_release:CMSSW_1_0_1', 'supersedes', 'cmssw_release:CMSSW_1_0_0', ''),
        ('edge', 'cmssw_release_family:CMSSW_1_0', 'contains', 'cmssw_release:CMSSW_1_0_0', ''),
        ('edge', 'cmssw_release_family:CMSSW_1_0', 'contains', 'cmssw_release:CMSSW_1_0_1', ''),
        ('health', 'endpoint_failed', 'open', '3/1', ''),
        ('node', 'cmssw_release:CMSSW_1_0_0', 'cmssw_release', '', 'label=CMSSW_1_0_0;state=Announced'),
        ('node', 'cmssw_release:CMSSW_1_0_1', 'cmssw_release', '', 'label=CMSSW_1_0_1'),
        ('node', 'cmssw_release_family:CMSSW_1_0', 'cmssw_release', '', 'family=CMSSW_1_0'),
    ],
    "conddb": [
        ('edge', 'global_tag:X_v1', 'depends_on', 'cmssw_release:CMSSW_1_0_0', ''),
        ('edge', 'global_tag:X_v2', 'depends_on', 'cmssw_release:CMSSW_9_9_9', ''),
        ('edge', 'global_tag:X_v2', 'supersedes', 'global_tag:X_v1', ''),
        ('health', 'ok', 'open', '2/0', ''),
        ('node', 'cmssw_release:CMSSW_9_9_9', 'cmssw_release', '', 'referenced_only=true'),
        ('node', 'global_tag:X_v1', 'global_tag', '', 'name=X_v1'),
        ('node', 'global_tag:X_v2', 'global_tag', '', 'name=X_v2;scenario=pp'),
    ],
    "dbs": [
        ('edge', 'dataset:/P/Run2018A-v2/AOD', 'derives_from', 'dataset:/P/Run2018A-v1/RAW', 'dst_tier=RAW;src_tier=AOD'),
        ('health', 'endpoint_failed', 'open', '2/1', ''),
        ('node', 'dataset:/P/Run2018A-v1/RAW', 'dataset', '', 'campaign=Run2018A;data_tier=RAW;era=Run2018A;total_events=10;total_files=0'),
        ('node', 'dataset:/P/Run2018A-v2/AOD', 'dataset', '', 'campaign=Run2018A;data_tier=AOD;era=Run2018A;total_events=0;total_files=3'),
    ],
    "github": [
        ('edge', 'software_repository:cms-sw/cmssw', 'references', 'repo:cms-sw/cmssw', ''),
        ('edge', 'software_repository:dmwm/CRAB', 'references', 'repo:dmwm/CRAB', ''),
        ('health', 'ok', 'complete', '3/0', ''),
        ('node', 'repo:cms-sw/cmssw', 'repo', '', 'slug=cms-sw/cmssw;url=https://github.com/cms-sw/cmssw'),
        ('node', 'repo:dmwm/CRAB', 'repo', '', 'slug=dmwm/CRAB;url=https://github.com/dmwm/CRAB'),
        ('node', 'software_repository:cms-sw/cmssw', 'software_repository', '', 'slug=cms-sw/cmssw;url=https://github.com/cms-sw/cmssw'),
        ('node', 'software_repository:dmwm/CRAB', 'software_repository', '', 'slug=dmwm/CRAB;url=https://github.com/dmwm/CRAB'),
    ],
    "dqm": [
        ('edge', 'data_certification:Cert_B', 'references', 'dataset:/A/B/RAW', ''),
        ('edge', 'data_certification:Cert_Collisions2018_A', 'recorded_during', 'run:5', ''),
        ('edge', 'data_certification:Cert_Collisions2018_A', 'recorded_during', 'run:9', ''),
        ('edge', 'data_certification:Cert_Collisions2018_A', 'references', 'dataset:/A/B/RAW', ''),
        ('health', 'endpoint_failed', 'open', '2/1', ''),
        ('node', 'data_certification:Cert_B', 'data_certification', '', 'group=Cert_B'),
        ('node', 'data_certification:Cert_Collisions2018_A', 'data_certification', '', 'group=Collisions2018;run_max=9;run_min=5;year=2018'),
        ('node', 'dataset:/A/B/RAW', 'dataset', '', ''),
        ('node', 'run:5', 'run', '', ''),
        ('node', 'run:9', 'run', '', ''),
    ],
    "gocdb": [
        ('edge', 'downtime:7', 'affects', 'site:T2_X', ''),
        ('edge', 'downtime:7', 'affects', 'svc:ce-svc', ''),
        ('health', 'endpoint_failed', 'open', '2/2', ''),
        ('node', 'downtime:7', 'downtime', '', 'affected_services=CE,SE;severity=OUTAGE'),
    ],
    "wmstats": [
        ('edge', 'workflow:w1', 'consumes', 'dataset:/A/B/RAW', ''),
        ('edge', 'workflow:w1', 'depends_on', 'cmssw_release:CMSSW_1_0_0', ''),
        ('edge', 'workflow:w1', 'produces', 'dataset:/A/B/RAW', ''),
        ('edge', 'workflow:w1', 'produces', 'dataset:/A/C/AOD', ''),
        ('edge', 'workflow:w2', 'produces', 'dataset:/A/D/AOD', ''),
        ('health', 'endpoint_failed', 'open', '2/1', ''),
        ('node', 'dataset:/A/B/RAW', 'dataset', '', ''),
        ('node', 'dataset:/A/C/AOD', 'dataset', '', ''),
        ('node', 'dataset:/A/D/AOD', 'dataset', '', ''),
        ('node', 'workflow:w1', 'workflow', '', 'priority=5;status=done'),
        ('node', 'workflow:w2', 'workflow', '', 'priority=0'),
    ],
    "wmstats_count": [
        ('health', 'endpoint_failed', 'open', '1/0', ''),
        ('node', 'workflow:w2', 'workflow', '', ''),
    ],
    "jira": [
        ('edge', 'chunk:9db1edff4dee58a4', 'references', 'jira:AB-1', 'match_type=jira_issue'),
        ('edge', 'chunk:f676171a16e4b0df', 'references', 'jira:AB-2', 'match_type=jira_issue'),
        ('edge', 'jira:AB-1', 'assigned_to', 'person:42ef41558e506e7c', ''),
        ('edge', 'jira:AB-1', 'contains', 'chunk:f676171a16e4b0df', 'chunk_index=0'),
        ('edge', 'jira:AB-1', 'linked_to', 'jira:AB-2', 'link_kind=blocks;link_type=Blocks; Relates'),
        ('edge', 'jira:AB-1', 'reported_by', 'person:5a214941106a55e8', ''),
        ('edge', 'jira:AB-2', 'contains', 'chunk:9db1edff4dee58a4', 'chunk_index=0'),
        ('health', 'endpoint_failed', 'open', '2/1', ''),
        ('node', 'chunk:9db1edff4dee58a4', 'document_chunk', '', 'text=summary: b\n\nlabels: l1 l2\n\nrecent_comments: x 2021: COVID-19 and AB-1'),
        ('node', 'chunk:f676171a16e4b0df', 'document_chunk', '', 'text=summary: see AB-2 by \n\nstatus: Open\n\nissue_links: AB-2'),
        ('node', 'jira:AB-1', 'jira_issue', '', 'status=Open;summary=see AB-2 by '),
        ('node', 'jira:AB-2', 'jira_issue', '', 'summary=b'),
        ('node', 'person:42ef41558e506e7c', 'person', '', 'name=Jo Do'),
        ('node', 'person:5a214941106a55e8', 'person', '', 'name=jdo'),
    ],
    "docs": [
        ('edge', 'chunk:c3b5b91d6b6951f3', 'references', 'cmssw_release:CMSSW_1_2_3', 'match_type=cmssw_release'),
        ('edge', 'chunk:c3b5b91d6b6951f3', 'references', 'site:T2_US_MIT', 'match_type=cms_site'),
        ('edge', 'chunk:c3b5b91d6b6951f3', 'references', 'svc:se1', 'match_type=infrastructure_service'),
        ('edge', 'documentation_page:c176a442013b7750', 'contains', 'chunk:228fbdbcf07952b5', 'chunk_index=0'),
        ('edge', 'documentation_page:org_repo:docs_p.md', 'contains', 'chunk:c3b5b91d6b6951f3', 'chunk_index=0'),
        ('edge', 'software_repository:org_repo', 'contains', 'documentation_page:org_repo:docs_p.md', ''),
        ('health', 'endpoint_failed', 'open', '3/1', ''),
        ('node', 'chunk:228fbdbcf07952b5', 'document_chunk', '', ''),
        ('node', 'chunk:c3b5b91d6b6951f3', 'document_chunk', '', ''),
        ('node', 'documentation_page:c176a442013b7750', 'documentation_page', '', 'title=B'),
        ('node', 'documentation_page:org_repo:docs_p.md', 'documentation_page', '', 'title=T'),
        ('node', 'software_repository:org_repo', 'software_repository', '', ''),
    ],
    "twiki": [
        ('edge', 'twiki:CMS:HiggsPhysics', 'contains', 'chunk:15ce52e97abf5899', 'chunk_index=0'),
        ('edge', 'twiki:CMS:HiggsPhysics', 'references', 'twiki:CMS:OtherTopic', 'kind=bare_wikiword'),
        ('edge', 'twiki:CMS:HiggsPhysics', 'references', 'twiki:Sub:Page', 'kind=wiki_link'),
        ('edge', 'twiki:CMS:OtherTopic', 'contains', 'chunk:aa4723eea50f192d', 'chunk_index=0'),
        ('edge', 'twiki:CMS:OtherTopic', 'references', 'twiki:CMS:HiggsPhysics', 'kind=topic_parent'),
        ('edge', 'twiki:Sub:Page', 'contains', 'chunk:eba428998546d73d', 'chunk_index=0'),
        ('health', 'endpoint_failed', 'open', '3/1', ''),
        ('node', 'chunk:15ce52e97abf5899', 'document_chunk', '', 'text=HiggsPhysics See p and OtherTopic now'),
        ('node', 'chunk:aa4723eea50f192d', 'document_chunk', '', 'text=OtherTopic mail  HiggsPhysics'),
        ('node', 'chunk:eba428998546d73d', 'document_chunk', '', 'text=Page x'),
        ('node', 'twiki:CMS:HiggsPhysics', 'documentation_page', '', 'author=me;last_modified=1970-01-01T00:00:00Z;text=HiggsPhysics See p and OtherTopic now;title=HiggsPhysics'),
        ('node', 'twiki:CMS:OtherTopic', 'documentation_page', '', 'parent_topic=HiggsPhysics;text=OtherTopic mail  HiggsPhysics;title=OtherTopic'),
        ('node', 'twiki:Sub:Page', 'documentation_page', '', 'text=Page x;title=Page'),
    ],
    "twiki_physics": [
        ('edge', 'twiki:CMS:Child', 'contains', 'chunk:1675425ff813bb65', ''),
        ('edge', 'twiki:CMS:Child', 'references', 'twiki:CMS:HiggsPhysics', ''),
        ('edge', 'twiki:CMS:GrandChild', 'contains', 'chunk:b7188dc29d2da2d5', ''),
        ('edge', 'twiki:CMS:GrandChild', 'references', 'twiki:CMS:Child', ''),
        ('edge', 'twiki:CMS:HiggsPhysics', 'contains', 'chunk:0bf7777e60df8a8f', ''),
        ('edge', 'twiki:CMS:HowToX', 'contains', 'chunk:8496b44c1d42b61e', ''),
        ('health', 'ok', 'complete', '8/0', ''),
        ('node', 'chunk:0bf7777e60df8a8f', 'document_chunk', '', ''),
        ('node', 'chunk:1675425ff813bb65', 'document_chunk', '', ''),
        ('node', 'chunk:8496b44c1d42b61e', 'document_chunk', '', ''),
        ('node', 'chunk:b7188dc29d2da2d5', 'document_chunk', '', ''),
        ('node', 'twiki:CMS:Child', 'documentation_page', '', 'title=Child'),
        ('node', 'twiki:CMS:GrandChild', 'documentation_page', '', 'title=GrandChild'),
        ('node', 'twiki:CMS:HiggsPhysics', 'documentation_page', '', 'title=HiggsPhysics'),
        ('node', 'twiki:CMS:HowToX', 'documentation_page', '', 'title=HowToX'),
    ],
    "hypernews": [
        ('edge', 'hn:prep/12', 'contains', 'chunk:e4844fd385d31295', ''),
        ('health', 'endpoint_failed', 'open', '1/1', ''),
        ('node', 'chunk:e4844fd385d31295', 'document_chunk', '', 'text=Q hi there'),
        ('node', 'hn:prep/12', 'forum_thread', '', 'author=A;reply_count=2;text=Q hi there;title=Q'),
    ],
    "indico": [
        ('edge', 'chunk:75a0191c269c8455', 'member_of', 'doc:indico:event/77/pdf/1', 'chunk_index=0'),
        ('edge', 'doc:indico:event/77/pdf/1', 'contains', 'chunk:75a0191c269c8455', 'chunk_index=0'),
        ('edge', 'meeting_minutes:77', 'contains', 'doc:indico:event/77/pdf/1', 'relationship=indico_pdf_attachment'),
        ('health', 'endpoint_failed', 'open', '1/1', ''),
        ('node', 'chunk:75a0191c269c8455', 'document_chunk', '', 'text=slide text'),
        ('node', 'doc:indico:event/77/pdf/1', 'document', '', 'path=event/77/pdf/1.pdf;title=S'),
        ('node', 'meeting_minutes:77', 'meeting_minutes', '', 'attachment_urls=https://i.org/f.pdf;category_id=5;chairs=Do, Jo;date=2021-02-03;label=Ops;speakers=A B;text=Ops C agenda Speakers: A B Chairs: Do, Jo;title=Ops'),
    ],
    "indico_live": [
        ('edge', 'meeting_minutes:77', 'contains', 'meeting_minutes:77:contribution:2', 'relationship=indico_contribution'),
        ('edge', 'meeting_minutes:77', 'contains', 'meeting_minutes:77:contribution:901', 'relationship=indico_contribution'),
        ('health', 'ok', 'complete', '1/0', ''),
        ('node', 'meeting_minutes:77', 'meeting_minutes', '', 'text=Ops;title=Ops;url=https://indico.cern.ch/event/77/'),
        ('node', 'meeting_minutes:77:contribution:2', 'meeting_minutes', '', 'session=S;text=Only an abstract Part of Ops. Session: S. Only an abstract;title=Only an abstract;url=https://o.org/x'),
        ('node', 'meeting_minutes:77:contribution:901', 'meeting_minutes', '', 'attachment_images=https://indico.cern.ch/f.pdf;attachment_urls=https://indico.cern.ch/f.pdf;date=2021-02-03T10:00;room=40/S2;speakers=A B;text=Talk & more Part of Ops. Speakers: A B (MIT) about Attachments: f.pdf;title=Talk & more;url=https://indico.cern.ch/event/77/contributions/901/'),
    ],
    "cds": [
        ('health', 'endpoint_failed', 'open', '3/1', ''),
        ('node', 'cds:11', 'cds_record', '', 'analysis_codes=SUS-08-005;creators=A; B;report_number=CMS-PAS-SUS-08-005;title=T'),
    ],
    "siteconf": [
        ('edge', 'site:T2_X', 'contains', 'siteconf:T2_X', ''),
        ('health', 'ok', 'complete', '3/0', ''),
        ('node', 'siteconf:T2_X', 'site_config', '', 'se_endpoints=e,se.x.org;storage_protocols=davs,root;text=SITECONF for T2_X\nProtocols: davs, root\nSE: e, se.x.org'),
        ('node', 'siteconf:T3_Y', 'site_config', '', 'text=SITECONF for T3_Y'),
    ],
    "cmssst": [
        ('edge', 'documentation_page:cmssst:T2_XX_A', 'contains', 'chunk:95f23c661349e051', ''),
        ('edge', 'documentation_page:cmssst:T2_XX_A', 'references', 'site:T2_XX_A', 'match_type=cmssst_site_status'),
        ('health', 'endpoint_failed', 'open', '1/2', ''),
        ('node', 'chunk:95f23c661349e051', 'document_chunk', '', ''),
        ('node', 'documentation_page:cmssst:T2_XX_A', 'documentation_page', '', "body=T2_XX_A current site status from the CMS Site Support Team (CMS SST) site status page.\nLife Status: ok (site state or evaluation good), latest evaluation.\nLife Status manual override: no manual override set at the snapshot time.\nProduction (Prod) Status: unknown (no evaluation yet today).\nProduction (Prod) Status manual override: not reported on the page.\nCRAB analysis (Crab) Status: not reported on the page.\nCRAB analysis (Crab) Status manual override: not reported on the page.\nRucio Status: not reported on the page.\nRucio Status manual override: not reported on the page.\nSite Readiness: not reported on the page.\nSAM Status: not reported on the page.\nFTS Status: unrecognised status code 'z', latest evaluation.\nHammerCloud: not reported on the page.\nDowntime: site or service in full downtime, at the snapshot time.\nSummary: not reported on the page.\nGGUS tickets listed for T2_XX_A: 12 (opened 1970-01-01, https://helpdesk.ggus.eu/#ticket/zoom/12).\nAlert: a & b\nSource: https://cmssst.web.cern.ch/siteStatus/detail.html?site=T2_XX_A;observed_at=2023-11-14T22:13:20+00:00;title=T2_XX_A site status"),
    ],
    "cric": [
        ('edge', 'facility:F', 'contains', 'site:T1_A', ''),
        ('edge', 'op:u', 'responsible_for', 'site:T1_A', 'role=admin'),
        ('edge', 'site:T1_A', 'contains', 'ce:cu1', ''),
        ('edge', 'site:T1_A', 'contains', 'se:se1', ''),
        ('health', 'endpoint_failed', 'open', '7/1', ''),
        ('node', 'ce:cu1', 'compute_endpoint', '', 'state=on'),
        ('node', 'facility:F', 'facility', '', 'country=X'),
        ('node', 'op:u', 'operator', '', 'user=u'),
        ('node', 'se:se1', 'storage_endpoint', '', 'state=on'),
        ('node', 'site:T1_A', 'site', '', 'sitedb_title=Alpha;status=on;tier_level=T1'),
    ],
    "cric_core": [
        ('edge', 'site:T1_A', 'contains', 'svc:s1', ''),
        ('edge', 'site:T1_A', 'member_of', 'fed:fed', ''),
        ('health', 'ok', 'complete', '6/0', ''),
        ('node', 'fed:fed', 'federation', '', 'pledge_cpu=3.0;pledge_year=2024'),
        ('node', 'svc:s1', 'infrastructure_service', '', 'endpoint=h.org'),
    ],
    "monit_sam": [
        ('edge', 'site:T1_A', 'hosts', 'monitoring_snapshot:sam:T1_A:2024-01-02', ''),
        ('health', 'ok', 'complete', '1/0', ''),
        ('node', 'monitoring_snapshot:sam:T1_A:2024-01-02', 'monitoring_snapshot', '', 'availability_pct=90.0;status=OK;total_tests=20'),
    ],
    "monit_condor": [
        ('edge', 'site:T1_A', 'hosts', 'monitoring_snapshot:condor:T1_A:2024-01-02', ''),
        ('health', 'ok', 'open', '1/0', ''),
        ('node', 'monitoring_snapshot:condor:T1_A:2024-01-02', 'monitoring_snapshot', '', 'cpu_efficiency=0.75;jobs_running=3;status_breakdown={"Running":3};total_jobs=4'),
    ],
    "monit_transfers": [
        ('edge', 'site:T1_A', 'hosts', 'transfer_job:rucio:T1_A:T2_B:2024-01-02', 'role=transfer_source'),
        ('edge', 'site:T1_A', 'transfers_to', 'site:T2_B', 'snapshot_date=2024-01-02'),
        ('edge', 'site:T2_B', 'hosts', 'transfer_job:rucio:T1_A:T2_B:2024-01-02', 'role=transfer_destination'),
        ('health', 'ok', 'complete', '1/0', ''),
        ('node', 'transfer_job:rucio:T1_A:T2_B:2024-01-02', 'transfer_job', '', 'bytes_total=100;done_count=4;failed_count=1'),
    ],
    "monit_datasets": [
        ('edge', 'se:T1_A', 'hosts', 'dataset:/a/b/RAW', 'relationship=dataset_replica_rse'),
        ('edge', 'se:T2_B_Disk', 'hosts', 'dataset:/a/b/RAW', 'relationship=dataset_replica_rse'),
        ('edge', 'site:T1_A', 'hosts', 'dataset:/a/b/RAW', 'relationship=dataset_replica'),
        ('edge', 'site:T2_B', 'hosts', 'dataset:/a/b/RAW', 'relationship=dataset_replica'),
        ('health', 'ok', 'complete', '1/0', ''),
        ('node', 'dataset:/a/b/RAW', 'dataset', '', 'label=/a/b/RAW'),
    ],
    "no_export": [
        ('health', 'cache_missing', 'open', '0/0', ''),
    ],
    "empty_mode": [
        ('health', 'ok', 'open', '1/0', ''),
        ('node', 'dataset:/a/b/RAW', 'dataset', '', ''),
    ],
}
