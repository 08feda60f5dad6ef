"""Fixed schemas of the tables the operators read and write."""

QUESTION = "struct<text:string,type:string,difficulty:string>"
ANSWER = "struct<text:string,type:string,length:string>"
RELATION = "struct<subject:string,relation:string,object:string>"
REVISION = "struct<timestamp:string,user:string>"
ENTITY = "struct<text:string,type:string>"
IMAGE = "struct<image_url:string,caption:string>"
METADATA = f"struct<length:int,source:string,source_url:string,revisions:array<{REVISION}>>"

RECORD_DDL = (
    "id string, title string, language string, category string, topic string, subtopic string, "
    "keywords array<string>, content string, summary string, "
    "content_embedding array<float>, summary_embedding array<float>, "
    f"questions array<{QUESTION}>, answers array<{ANSWER}>, relations array<{RELATION}>, "
    f"created_at timestamp, metadata {METADATA}, entities array<{ENTITY}>, images array<{IMAGE}>, "
    "cluster int, wikidata_id string, image_url string"
)

PAGE_TASK_DDL = "title string, url string, lang string, category string, depth int, weight double"
RAW_PAGE_DDL = "url string, html string"
LINK_DDL = "src string, pos int, url string, dst string"
MEMBERSHIP_DDL = "parent string, member string, ns int, url string, pos int"
JOB_DDL = "lang array<string>, category array<string>, format string"
QA_PAYLOAD_DDL = (
    "lang string, category string, "
    "items array<struct<title:string,body:string,score:bigint,link:string>>"
)
ENTITY_PAYLOAD_DDL = (
    "lang string, category string, search array<struct<id:string,label:string,description:string>>, "
    "entities map<string,struct<"
    "labels:map<string,struct<value:string>>,"
    "descriptions:map<string,struct<value:string>>,"
    "claims:map<string,array<struct<mainsnak:struct<datavalue:struct<value:string>>>>>>>"
)
REVISION_PAYLOAD_DDL = f"query struct<pages:map<string,struct<revisions:array<{REVISION}>>>>"
RELATED_PAYLOAD_DDL = "query struct<pages:map<string,struct<links:array<struct<ns:int,title:string>>>>>"
