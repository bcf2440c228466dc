"""Canonical schemas: one key column for each entity, explicit types, no inference."""

from __future__ import annotations

AUTHOR = "struct<author_id:string,name:string,name_zh:string,org:string,org_zh:string,org_id:string,email:string,homepage:string,orc_id:string>"

SCHEMAS = {
    "paper": f"paper_id string, title string, title_zh string, abstract string, abstract_zh string, authors array<{AUTHOR}>, doi string, issn string, issue string, volume string, year int, keywords array<string>, keywords_zh array<string>, venue_raw string, venue_id string, venue_name string, venue_name_zh string, n_citation bigint, url string, is_sci boolean",
    "citation": "paper_id string, pos int, cited_id string, cited_title string, n_citation bigint",
    "scholar": "person_id string, name string, name_zh string, org string, org_zh string, org_id string, interests array<string>, n_citation bigint, bio string, bio_zh string, edu string, edu_zh string, orgs array<string>, org_zhs array<string>, position string, position_zh string, domain string, honor string, award string, year int",
    "figure": "person_id string, ai_interests array<string>, ai_domain array<string>, edus array<struct<school:string,degree:string,date:string>>, works array<struct<org:string,title:string,date:string>>",
    "scholar_paper": "person_id string, paper_id string, title string",
    "scholar_patent": "person_id string, patent_id string, title string, title_en string, title_zh string",
    "project": "project_id string, person_id string, titles string, country string, project_source string, fund_amount decimal(18,2), fund_currency string, start_date date, end_date date",
    "org": "org_id string, name string, name_en string, name_zh string, acronyms array<string>, aliases array<string>, details string, type string, location string, language string, parent_org_id string",
    "org_alias": "alias_norm string, secondary_id string, secondary_name string, primary_id string, primary_name string",
    "venue": "venue_id string, name string, name_en string, name_zh string, issn string, eissn string, alias array<string>, type string",
    "venue_paper": "venue_id string, paper_id string, year int",
    "org_patent": "org_id string, patent_id string",
    "patent": "patent_id string, title string, title_zh string, abstract string, app_num string, app_date date, pub_num string, pub_date date, pub_kind string, assignee array<string>, inventor array<string>, country string, sequence string, ipc array<string>, ipcr array<string>, cpc array<string>, priority string, description string",
}
