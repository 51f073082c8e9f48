"""Site configuration: URL templates, allowed domains and paging.

The templates are format strings (B5): '%s', or '%1$s' where one value is used
twice.  The defaults name no real site.  A deployment passes its own
``SiteTemplates``, from whatever file or arguments it keeps them in.  A search
page's url must hold its number as ``page=``.
"""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass(frozen=True)
class SiteTemplates:
    seed_url: str = "https://api.catalogue.example/brands"
    brand_logo: str = "https://static.catalogue.example/logos/%s.png"
    car_list: str = "https://api.catalogue.example/brands/%s/cars"
    version_list: str = "https://api.catalogue.example/cars/%s/versions"
    spec_page: str = "https://www.catalogue.example/versions/%s/specification"
    level_search: str = "https://api.catalogue.example/levels/%s/cars?page=%s&size=%s"
    car_page: str = "https://www.catalogue.example/cars/%s"
    allowed_domains: tuple[str, ...] = field(default=("catalogue.example",))
    # Fixed value: rows per level-search page.
    page_size: int = 100


DEFAULT_SITE = SiteTemplates()
