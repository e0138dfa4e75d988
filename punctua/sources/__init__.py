from punctua.sources.commits import *  # noqa: F401,F403
from punctua.sources.exports import *  # noqa: F401,F403
from punctua.sources.landing import *  # noqa: F401,F403
from punctua.sources.tables import *  # noqa: F401,F403
