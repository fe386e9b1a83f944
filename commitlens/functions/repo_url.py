"""Repository URLs as column expressions."""

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the shape of an accepted repository URL.
REPO_URL_PATTERN = (
    r"^https://(www\.)?(github|gitlab)\.com/[A-Za-z0-9_-]+/[A-Za-z0-9_-]+(\.git)?/?$"
)


def is_repo_url(url: Column) -> Column:
    """Does `url` look like a GitHub or GitLab repository?"""
    return url.rlike(REPO_URL_PATTERN)


def repo_link(url: Column) -> Column:
    """`url` without trailing slashes and without a `.git` ending."""
    bare = F.rtrim(url, F.lit("/"))
    return F.rtrim(
        F.when(bare.endswith(".git"), F.left(bare, F.length(bare) - 4)).otherwise(bare),
        F.lit("/"),
    )


def repo_id(url: Column) -> Column:
    """`<owner>_<name>`, from the last two path parts; null when either is missing."""
    parts = F.split(repo_link(url), "/")
    owner, name = (F.get(parts, F.size(parts) - back) for back in (2, 1))
    return F.when((owner != "") & (name != ""), F.concat(owner, F.lit("_"), name))
