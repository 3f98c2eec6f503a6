"""Names and values that a result must carry to be right, kept in one place."""

from __future__ import annotations

from pyspark.sql import types as T

# Markup vocabulary of the captured pages.
POST_CONTAINER = "fie-impression-container"
AUTHOR_CLASS = "update-components-actor__name"
TIME_CLASS = "update-components-actor__sub-description"
DESCRIPTION_CLASS = "update-components-text"
BODY_CLASS = "break-words"
BUTTON_TEXT_CLASS = "update-components-button__text"
VIEW_JOB_LABEL = "View job"
HIDDEN_CLASS = "visually-hidden"
HIDDEN_LABEL = "hashtag"
JOB_LIST_CLASS = "scaffold-layout__list-container"
JOB_LOCATION_CLASS = "job-card-container__metadata-item"
JOB_COMPANY_CLASS = "job-card-container__primary-description"

# Text shown for a missing field.
NOT_AVAILABLE = "N/A"

# Output columns, as (internal name, display name), in order.
POST = (
    ("author", "Author"),
    ("description", "Description"),
    ("time_posted", "Time Posted"),
    ("post_link", "Post Link"),
)
PROFILE_POST = (
    ("author", "Author"),
    ("description", "Description"),
    ("time_posted", "Time Posted"),
    ("profile_link", "Profile Link"),
)
LINK_ONLY = (("post_link", "Post Link"),)
VIEW_JOB_POST = (
    ("author", "Author Name"),
    ("post_link", "Post Link"),
    ("time_posted", "Time Posted"),
    ("content", "Content"),
)
JOB = (
    ("job_title", "Job Title"),
    ("location", "Location"),
    ("company_name", "Company_Name"),
)

#: What a captured page looks like; ``feed`` names one search result list.
CAPTURED_PAGES = T.StructType(
    [
        T.StructField("page_id", T.LongType()),
        T.StructField("feed", T.StringType()),
        T.StructField("page_no", T.IntegerType()),
        T.StructField("round", T.IntegerType()),
        T.StructField("url", T.StringType()),
        T.StructField("html", T.StringType()),
        T.StructField("captured_at", T.TimestampType()),
    ]
)

def string_schema(columns) -> T.StructType:
    """The declared schema of one of the output column lists above."""
    return T.StructType([T.StructField(shown, T.StringType()) for _, shown in columns])
