"""Record curation on Spark: collect, convert, enrich, merge and check records."""

from .functions import *  # noqa: F401,F403
from .operators import *  # noqa: F401,F403
from .plans import *  # noqa: F401,F403
from .session import clear_scratch, configure, scratch_mark, scratch_path, shared_dir  # noqa: F401
from .sources import *  # noqa: F401,F403
from .streaming import *  # noqa: F401,F403
