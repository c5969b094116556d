"""Site rules: listing pages to job URLs, detail pages to canonical records.

A site is data: where its listings, its last page and its fields are found.  One interpreter applies
the rules of all sites; each field has a list of places, and the first that yields anything counts.
The functions run in Python over Arrow batches, a page at a time.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from typing import Any
from urllib.parse import urljoin, urlsplit

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from listweave.functions import html as H
from listweave.shipping import ship
from listweave.vocabulary import RECORD

# -- places: each is a function of the page, and of what is known about it --------------------------


@dataclass
class Page:
    """A parsed detail page with what several rules share."""

    root: H.Node
    url: str
    posting: dict
    data: dict = field(default_factory=dict)


Place = Callable[[Page], Any]


def css(selector: str) -> Place:
    """Text of the first element."""
    return lambda p: H.text_of(p.root.find(selector))


def css_all(selector: str, item: str | None = None) -> Place:
    """Texts of all elements, or of ``item`` elements in the first."""
    def run(p: Page):
        if item is None:
            return H.unique(H.text_of(n) for n in p.root.find_all(selector))
        box = p.root.find(selector)
        return H.unique(H.text_of(n) for n in box.find_all(item)) if box else []
    return run


def attribute(selector: str, name: str) -> Place:
    return lambda p: H.tidy((p.root.find(selector) or H.Node("x", {}, None)).attrs.get(name))


def ld(*path: str) -> Place:
    """A value of the JSON-LD posting; objects give their name or value, HTML gives its text."""
    def run(p: Page):
        value: Any = p.posting
        for step in path:
            value = value.get(step) if isinstance(value, dict) else None
        return _plain(value)
    return run


def _plain(value: Any) -> str | None:
    """Readable text of a JSON value: markup gives its text, an object its name, anything else its JSON."""
    match value:
        case None | "":
            return None
        case {"name": str(text)}:
            return H.tidy(text)
        case str(text):
            markup = "<" in text
            return H.text_of(H.parse(text)) if markup else H.tidy(text)
        case _:
            return json.dumps(value, ensure_ascii=False, sort_keys=True)


def ld_list(name: str) -> Place:
    """A comma-separated text, or names of a list's objects."""
    def run(p: Page):
        value = p.posting.get(name)
        if isinstance(value, str):
            return H.unique(H.text_of(n) for n in H.parse(value).find_all("li")) if "<li" in value else H.unique(value.split(","))
        keys = ("skillName", "benefitNameVI", "benefitName", "benefitValue", "name", "value")
        return H.unique(next((x[k] for k in keys if x.get(k)), None) if isinstance(x, dict) else x for x in value) if isinstance(value, list) else []
    return run


def ld_items(name: str) -> Place:
    """List items of an HTML value, else its lines."""
    def run(p: Page):
        value = p.posting.get(name)
        return H.items_of(H.parse(value)) if isinstance(value, str) and value.strip() else ld_list(name)(p)
    return run


def ld_places(p: Page) -> list[str]:
    return H.posting_locations(p.posting)


def ld_identifier(p: Page) -> str | None:
    return H.posting_identifier(p.posting)


def _next_element(node: H.Node) -> H.Node | None:
    kids = [k for k in node.parent.kids if isinstance(k, H.Node)] if node.parent else []
    at = next((i for i, k in enumerate(kids) if k is node), len(kids))
    return kids[at + 1] if at + 1 < len(kids) else None


def _heading(p: Page, headings: str, labels: tuple[str, ...]) -> H.Node | None:
    wanted = {x.casefold() for x in labels}
    for s in headings.split(","):
        for n in p.root.find_all(s.strip()):
            if (H.text_of(n) or "").rstrip(":").strip().casefold() in wanted:
                return n
    return None


def _body(p: Page, headings: str, labels: tuple[str, ...], within: str | None, content: str | None) -> H.Node | None:
    node = _heading(p, headings, labels)
    if node is None:
        return None
    if within:  # the section is the nearest ancestor of this kind
        step = H.parse_step(within)
        up = node.parent
        while up is not None and not (up.tag != "#root" and H._matches(up, step)):
            up = up.parent
        return (up.find(content) if content else up) if up is not None else None
    body = _next_element(node)
    if body is None and node.parent is not None and node.parent.tag != "#root":
        body = _next_element(node.parent)
    # an empty section must not take the next one's heading or body
    if body is None or body.tag in H.HEADINGS or any(body.find(s.strip()) for s in headings.split(",")):
        return None
    return body


def section(headings: str, *labels: str, within: str | None = None, content: str | None = None) -> Place:
    """Text of the section under a heading, without the heading itself."""
    def run(p: Page):
        text = H.text_of(_body(p, headings, labels, within, content))
        if text:
            lines = text.split("\n")
            if lines[0].rstrip(":").casefold() in {x.casefold() for x in labels}:
                lines = lines[1:]
            return H.tidy("\n".join(x for x in lines if x != "-"))
        return None
    return run


def section_items(headings: str, *labels: str, within: str | None = None, content: str | None = None, item: str = "li", lines: bool = True) -> Place:
    def run(p: Page):
        body = _body(p, headings, labels, within, content)
        if body is None:
            return []
        return H.unique(H.text_of(n) for n in body.find_all(item)) or (H.unique((H.text_of(body) or "").splitlines()) if lines else [])
    return run


def labelled(items: str, label: str, value: str | None, name: str) -> Place:
    """Value beside a label: in a list of items, the one whose label reads ``name``."""
    def run(p: Page):
        for n in p.root.find_all(items):
            tag = n.find(label) if label else n
            if tag is not None and (H.text_of(tag) or "").rstrip(":").strip() == name:
                found = n.find(value) if value else _next_element(tag)
                return H.text_of(found)
        return None
    return run


def labelled_items(items: str, label: str, name: str, item: str) -> Place:
    def run(p: Page):
        for n in p.root.find_all(items):
            tag = n.find(label) if label else n
            if tag is not None and name in (H.text_of(tag) or ""):
                box = n if label else _next_element(tag)
                return H.unique(H.text_of(x) for x in box.find_all(item)) if box else []
        return []
    return run


def url_part(pattern: str, upper: bool = False) -> Place:
    def run(p: Page):
        m = re.search(pattern, urlsplit(p.url).path)
        return (m[1].upper() if upper else m[1]) if m else None
    return run


def constant(value: Any) -> Place:
    return lambda p: value


def lines_of(place: Place) -> Place:
    return lambda p: H.unique((place(p) or "").splitlines())


def one(place: Place) -> Place:
    """A text as a list of one."""
    return lambda p: H.unique([place(p)])


def split(place: Place) -> Place:
    return lambda p: H.unique((place(p) or "").split(","))


def joined(place: Place) -> Place:
    return lambda p: "\n".join(place(p) or []) or None


def until_heading(place: Place, *headings: str) -> Place:
    """Text up to a line that begins with one of the headings."""
    mark = re.compile(r"(?im)^\s*(?:" + "|".join(re.escape(h).replace(r"\ ", r"\s+") for h in headings) + r")\s*(?:[:.!?\-]|$)")

    def run(p: Page):
        text = place(p)
        m = mark.search(text) if text else None
        return H.tidy(text[: m.start()]) if m else text
    return run


def day(place: Place) -> Place:
    """``dd/mm/yyyy`` as an ISO day."""
    def run(p: Page):
        m = re.search(r"(\d{2})/(\d{2})/(\d{4})", place(p) or "")
        return f"{m[3]}-{m[2]}-{m[1]}" if m else None
    return run


def salary(p: Page) -> str | None:
    """A salary from the posting: its value, else its range with the currency."""
    base = p.posting.get("baseSalary")
    value = base.get("value") if isinstance(base, dict) else None
    if not isinstance(value, dict):
        return None
    if value.get("value"):
        return H.tidy(value["value"])
    ends = [str(value[k]) for k in ("minValue", "maxValue") if value.get(k) is not None]
    return f"{' - '.join(ends)} {base.get('currency', '')}".strip() if ends and any(value.get(k) for k in ("minValue", "maxValue")) else None


# -- hydration data --------------------------------------------------------------------------------


def next_data(root: H.Node) -> dict:
    """API answers in a page's hydration script; empty if there is none or it is malformed."""
    script = root.find("script#__NEXT_DATA__")
    try:
        api = json.loads("".join(k for k in script.kids if isinstance(k, str)))["props"]["initialState"]["api"] if script else {}
    except (ValueError, KeyError, TypeError):
        return {}
    return api if isinstance(api, dict) else {}


def answer(api: dict, name: str) -> dict:
    got = api.get(name)
    data = got.get("data") if isinstance(got, dict) and got.get("code") == 200 else None
    return data if isinstance(data, dict) else {}


def hydrated(*path: str, as_html: bool = False) -> Place:
    def run(p: Page):
        value: Any = p.data.get("job") or {}
        for step in path:
            value = value.get(step) if isinstance(value, dict) else None
        if value is None or value == "":
            return None
        return H.text_of(H.parse(value)) if as_html and isinstance(value, str) else H.tidy(value) if not isinstance(value, list) else H.unique(value)
    return run


def coded(table: str, name: str, key: str = "id") -> Place:
    """Labels of the codes in a hydration field, by the page's own table."""
    def run(p: Page):
        rows = p.data.get("common", {}).get(table) or []
        names = {str(r.get(key)): r.get("name") for r in rows if isinstance(r, dict)}
        codes = (p.data.get("job") or {}).get(name)
        codes = codes if isinstance(codes, list) else [codes]
        return H.unique(names.get(str(c)) for c in codes)
    return run


def hydrated_places(p: Page) -> list[str]:
    job, common = p.data.get("job") or {}, p.data.get("common") or {}
    names = {str(r.get("id")): r.get("name") for r in common.get("provinces") or [] if isinstance(r, dict)}
    out = []
    for place in job.get("places") or []:
        if isinstance(place, dict):
            codes = place.get("province_id")
            codes = codes if isinstance(codes, list) else [codes]
            out.append(", ".join(H.unique([place.get("address"), *[names.get(str(c)) for c in codes]])))
    return H.unique(out)


def comma(place: Place) -> Place:
    return lambda p: ", ".join(place(p) or []) or None


# -- sites -----------------------------------------------------------------------------------------


@dataclass(frozen=True)
class Site:
    """Rules of one site.  ``fields`` gives places by field; ``variants`` chooses other fields by a selector."""

    source: str
    host: str
    listing_links: tuple[str, ...]
    listing_path: str
    fields: dict[str, tuple[Place, ...]]
    variants: tuple[tuple[str, str, dict[str, tuple[Place, ...]]], ...] = ()
    last_page: Callable[[H.Node, str], int | None] | None = None
    item_list: bool = False
    fixed_host: bool = False
    slash: bool = True
    needs_posting: bool = False
    infos: tuple[tuple[str, str, str], ...] = ()
    version: str = "1.0.0"
    hydration: tuple[str, str] | None = None
    #: What identifies a listing in its path; of several URLs of one listing the first counts.
    listing_id: str = ""


def page_links(selector: str) -> Callable[[H.Node, str], int | None]:
    """Largest ``page=`` number among links of a pagination element."""
    def run(root: H.Node, url: str) -> int | None:
        box = root.find(selector)
        if box is None:
            return None
        numbers = [int(m[1]) for a in box.find_all("a") if (m := re.search(r"[?&]page=(\d+)", a.attrs.get("href", "")))]
        if numbers:
            return max(numbers)
        return 1 if (active := box.find(".active")) is not None and (H.text_of(active) or "").strip() == "1" else None
    return run


def page_text(selector: str, pattern: str, per_page: int = 0) -> Callable[[H.Node, str], int | None]:
    """A number in a text: of pages, or of listings at ``per_page`` a page."""
    def run(root: H.Node, url: str) -> int | None:
        for n in root.find_all(selector):
            m = re.search(pattern, H.text_of(n) or "")
            if m:
                number = int(re.sub(r"[.,]", "", m[1]))
                return max(1, -(-number // per_page)) if per_page else number
        return None
    return run


def page_controls(root: H.Node, url: str) -> int | None:
    """Largest number among pagination controls, by text or label."""
    found = []
    for n in root.find_all("button") + root.find_all("a"):
        for text in (H.text_of(n) or "", n.attrs.get("aria-label", "")):
            m = re.fullmatch(r"(?:.*\bpage\s+)?(\d{1,5})", text.strip(), re.I)
            if m:
                found.append(int(m[1]))
    return max(found, default=None)


def page_state(pattern: str, per: str | None = None) -> Callable[[H.Node, str], int | None]:
    """A literal number in the page's scripts; with ``per``, total divided by page size."""
    def run(root: H.Node, url: str) -> int | None:
        code = " ".join("".join(k for k in s.kids if isinstance(k, str)) for s in root.find_all("script")).replace('\\"', '"')
        m = re.search(pattern, code)
        if not m:
            return None
        if per is None:
            return int(m[1])
        size = re.search(per, code)
        return max(1, -(-int(m[1]) // int(size[1]))) if size and int(size[1]) else None
    return run


def page_answer(name: str) -> Callable[[H.Node, str], int | None]:
    def run(root: H.Node, url: str) -> int | None:
        todo: list[Any] = [next_data(root)]
        while todo:
            v = todo.pop()
            if isinstance(v, dict):
                if isinstance(v.get(name), int) and not isinstance(v.get(name), bool):
                    return v[name]
                todo += list(v.values())
            elif isinstance(v, list):
                todo += v
        return None
    return run


_LD_DATES = {"posted_at": (ld("datePosted"),), "expires_at": (ld("validThrough"),)}
_LD_COMMON = {
    "skills_raw": (ld_list("skills"),), "locations_raw": (ld_places,), "categories_raw": (ld_list("industry"),), "employer_name_raw": (ld("hiringOrganization"),), **_LD_DATES,
}

# Addresses, selectors, labels and headings as the sites use them.
_DESCRIPTION, _REQUIREMENTS, _CANDIDATE = "Mô tả công việc", "Yêu cầu công việc", "Yêu cầu ứng viên"
_BENEFIT_HEADINGS = ("quyền lợi và chế độ", "quyền lợi", "phúc lợi", "chế độ đãi ngộ", "benefits", "benefit", "what we offer", "why you'll love working here")
_ITVIEC = {"within": "div.imy-5.paragraph"}
_NORMAL = {"within": "div.box-job-information-detail-item", "content": "div.box-job-information-detail-item__text"}
_PREMIUM = {"within": "div.premium-job-description__box", "content": "div.premium-job-description__box--content"}
_TOPCV_SHARED = {
    "categories_raw": (labelled_items("div.job-tags__group", ".job-tags__group-name", "Chuyên môn:", "a.item"),),
}


def _topcv(heading: str, where: dict, title: Place, employer: Place, domains: Place) -> dict[str, tuple[Place, ...]]:
    item = ".box-job-information-address-and-time-list__item"
    return _TOPCV_SHARED | {
        "title": (title,), "employer_name_raw": (employer,), "domains_raw": (domains,),
        "description_text": (section(heading, _DESCRIPTION, **where),),
        "requirements_text": (section(heading, _CANDIDATE, **where),),
        "benefits_text": (section(heading, "Quyền lợi ứng viên", **where),),
        "locations_raw": (
            labelled_items(item, f"{item}--title", "Địa điểm làm việc", "li"), one(labelled(item, f"{item}--title", f"{item}--content", "Địa điểm làm việc")),
            ld_places, one(section(heading, "Địa điểm làm việc", **where)),
        ),
    }


SITES: dict[str, Site] = {s.source: s for s in (
    Site("itviec", "itviec.com", ("h3[data-url]", "h3 a", "a"), r"^/it-jobs/[^/?]+-\d", {
        "title": (css("div.job-header-info h1"),), "employer_name_raw": (css("div.job-header-info div.employer-name"),),
        "description_text": (section("h2", "Job description", **_ITVIEC),), "requirements_text": (section("h2", "Your skills and experience", **_ITVIEC),),
        "benefits_text": (section("h2", "Why you'll love working here", **_ITVIEC),), "benefit_items": (section_items("h2", "Why you'll love working here", lines=False, **_ITVIEC),),
        "domains_raw": (css_all("div.itag.bg-light-grey.itag-sm.cursor-default"),),
        "categories_raw": (labelled_items("div", "", "Job Expertise:", "a"),), "skills_raw": (labelled_items("div", "", "Skills:", "a"),),
        "locations_raw": (css_all(".job-show-info span.normal-text"), ld_places),
    }, last_page=page_links("div.pagination"), version="1.0.2"),
    Site("topcv", "www.topcv.vn", (), r"^/(?:viec-lam|brand)/", {}, variants=(
        ("div#job-detail", "normal", _topcv("h2.box-job-information-detail-item__title--title", _NORMAL, attribute("div#job-detail", "data-job-title"), css("div.box-company-info__detail a.name"), lambda p: css_all("div.ctn-breadcrumb-detail a")(p)[1:-1])),
        ("h2.premium-job-basic-information__content--title", "premium", _topcv("h2.premium-job-description__box--title", _PREMIUM, css("h2.premium-job-basic-information__content--title"), css("a.company-content__name h1.title"), split(attribute("meta[name=keywords]", "content")))),
    ), last_page=page_text("span", r"/\s*(\d+)\s*trang"), item_list=True),
    Site("topdev", "topdev.vn", ("a",), r"^/detail-jobs/", _LD_COMMON | {
        "title": (ld("title"), css("h1")), "categories_raw": (constant(["Information Technology"]),), "domains_raw": (ld_list("industry"),),
        "description_text": (section("h2, h3", "Your role & responsibilities"), ld("description")),
        "requirements_text": (section("h2, h3", "Your skills & qualifications"), ld("experienceRequirements")),
        "benefits_text": (section("h2, h3", "Benefits for you", "Benefits"), ld("jobBenefits")), "benefit_items": (section_items("h2, h3", "Benefits for you", "Benefits"), ld_items("jobBenefits")),
        "source_external_job_id": (ld_identifier,), "salary_raw": (ld("baseSalary"),), "employment_type_raw": (ld("employmentType"),), "experience_raw": (ld("experienceRequirements"),),
    }, last_page=page_controls, needs_posting=True, infos=(("categories_raw", "inferred_category", "The site shows no category; a fixed one is used"),), version="1.0.2"),
    Site("vietnamworks", "www.vietnamworks.com", ("a",), r"-\d+-jv/?$", _LD_COMMON | {
        "title": (ld("title"), css("h1")), "description_text": (ld("description"),),
        "requirements_text": (until_heading(section("h2", _REQUIREMENTS), *_BENEFIT_HEADINGS), ld("experienceRequirements")),
        "benefits_text": (joined(ld_items("jobBenefits")), section("h2", "Quyền lợi", "Quyền lợi và chế độ", "Phúc lợi", "Benefits")),
        "benefit_items": (ld_items("jobBenefits"), section_items("h2", "Quyền lợi", "Quyền lợi và chế độ", "Phúc lợi", "Benefits")),
        "source_external_job_id": (ld_identifier,), "salary_raw": (ld("baseSalary"),), "employment_type_raw": (ld("employmentType"),), "experience_raw": (ld("experienceRequirements"),),
    }, needs_posting=True, version="1.0.2"),
    Site("devwork", "devwork.vn", ("#list-job-container .job-list a",), r"^/viec-lam/\d+/", {
        "title": (css(".header-details h1"),), "employer_name_raw": (css(".header-details h5"),),
        "description_text": (section(".background-content-job h2.block-title", _DESCRIPTION),), "requirements_text": (section(".background-content-job h2.block-title", _REQUIREMENTS),),
        "benefits_text": (section(".background-content-job h2.block-title", "Quyền lợi ứng viên"),), "benefit_items": (lines_of(section(".background-content-job h2.block-title", "Quyền lợi ứng viên")),),
        "skills_raw": (css_all(".background-content-job .tags a"),),
        "locations_raw": (lambda p: H.unique([css(".header-details p")(p), section(".background-content-job h2.block-title", "Địa chỉ làm việc")(p)]),),
        "source_external_job_id": (url_part(r"^/viec-lam/(\d+)/[^/]+/?$"),), "salary_raw": (css(".salary-amount"),),
        "employment_type_raw": (labelled(".job-overview .location-profile-job", "strong", "span", "Hình thức"),), "experience_raw": (labelled(".job-overview .location-profile-job", "strong", "span", "Kinh nghiệm"),),
        "expires_at": (labelled(".job-overview .location-profile-job", "strong", "span", "Hạn nộp hồ sơ"),),
    }, last_page=page_state(r"total_pages[\"']?\s*[:=]\s*(\d+)"), fixed_host=True, slash=False, version="1.0.1"),
    Site("careerviet", "careerviet.vn", (".job-item a.job_link",), r"\.[0-9A-Fa-f]{8}\.html$", _LD_COMMON | {
        "title": (css(".apply-now-banner h1.title"), ld("title")), "employer_name_raw": (css(".apply-now-banner .job-company-name"), ld("hiringOrganization")),
        "description_text": (section("h2.detail-title, h3.detail-title", _DESCRIPTION),), "requirements_text": (section("h2.detail-title, h3.detail-title", _REQUIREMENTS),),
        "benefits_text": (joined(css_all(".welfare-list li")), joined(ld_list("jobBenefits")), section("h2.detail-title, h3.detail-title", "Phúc lợi")),
        "benefit_items": (css_all(".welfare-list li"), ld_list("jobBenefits")),
        "categories_raw": (labelled_items(".job-detail-content .detail-box li", "strong", "Ngành nghề", "p a"), ld_list("industry")),
        "locations_raw": (css_all(".info-place-detail .place-name"), ld_places),
        "source_external_job_id": (ld_identifier, url_part(r"\.([0-9a-fA-F]{8})\.html$", upper=True)),
        "salary_raw": (labelled(".job-detail-content .detail-box li", "strong", "p", "Lương"), salary),
        "employment_type_raw": (labelled(".job-detail-content .detail-box li", "strong", "p", "Hình thức"), comma(ld_list("employmentType")), ld("employmentType")),
        "experience_raw": (labelled(".job-detail-content .detail-box li", "strong", "p", "Kinh nghiệm"), ld("experienceRequirements", "description"), ld("experienceRequirements")),
        "expires_at": (ld("validThrough"), day(labelled(".job-detail-content .detail-box li", "strong", "p", "Hết hạn nộp"))),
    }, last_page=page_state(r'"totalJobs"\s*:\s*"?(\d+)', r'"limit"\s*:\s*"?(\d+)'), fixed_host=True, version="1.0.1"),
    Site("vieclam24h", "vieclam24h.vn", ("a",), r"-c\d+p\d+id\d+\.html$", _LD_DATES | {
        "title": (hydrated("title"),), "employer_name_raw": (hydrated("employer_info", "name"),),
        "description_text": (hydrated("description_html", as_html=True), hydrated("description", as_html=True)),
        "requirements_text": (hydrated("other_requirement_html", as_html=True), hydrated("other_requirement", as_html=True)),
        "benefits_text": (hydrated("benefit_html", as_html=True), hydrated("benefit", as_html=True)),
        "benefit_items": (lambda p: H.items_of(H.parse((p.data.get("job") or {}).get("benefit_html") or (p.data.get("job") or {}).get("benefit") or "")),),
        "categories_raw": (coded("occupation", "occupation_ids_main"),), "skills_raw": (hydrated("skills_new"),), "locations_raw": (hydrated_places, coded("provinces", "province_ids")),
        "source_external_job_id": (hydrated("id"),), "salary_raw": (salary, comma(coded("job_salary_range", "salary_range", "value"))),
        "employment_type_raw": (comma(coded("job_working_method", "working_method", "value")),), "experience_raw": (comma(coded("job_experience_range", "experience_range", "value")),),
    }, last_page=page_answer("total_pages"), fixed_host=True, hydration=("jobDetailHiddenContact", "initCommon")),
    Site("careerlink", "www.careerlink.vn", ("li.job-item a.job-link",), r"^/tim-viec-lam/[^/]+/\d+", _LD_COMMON | {
        "title": (css("#job-title"),), "description_text": (section("#job-description", _DESCRIPTION), lambda p: _after(p, "#job-description")), "requirements_text": (lambda p: _after(p, "#job-skill"),),
        "benefits_text": (lambda p: _after(p, "#job-benefit"),), "benefit_items": (lambda p: _after_items(p, "#job-benefit"),),
        "source_external_job_id": (url_part(r"^/tim-viec-lam/[^/]+/(\d+)/?$"),), "salary_raw": (css("#job-salary .text-primary"),),
        "employment_type_raw": (labelled("#job-summary .job-summary-item", ".summary-label", None, "Loại công việc"),), "experience_raw": (labelled("#job-summary .job-summary-item", ".summary-label", None, "Kinh nghiệm"),),
    }, last_page=page_links(".pagination"), fixed_host=True, slash=False, listing_id=r"/(\d+)/?$"),
    Site("jobsgo", "jobsgo.vn", (".job-list .job-title a",), r"^/viec-lam/[^/]+-\d+\.html$", _LD_COMMON | {
        "title": (css("h1.job-title"),), "employer_name_raw": (css(".job-detail-card .card-company h6"), ld("hiringOrganization"), css(".card-company h6")),
        "description_text": (section(".job-detail-card h3.section-title", _DESCRIPTION),), "requirements_text": (section(".job-detail-card h3.section-title", _REQUIREMENTS),),
        "benefits_text": (section(".job-detail-card h3.section-title", "Quyền lợi được hưởng"),), "benefit_items": (section_items(".job-detail-card h3.section-title", "Quyền lợi được hưởng", lines=False),),
        "categories_raw": (ld_list("industry"), labelled_items(".job-detail-card .text-muted", "", "Ngành nghề", "a")), "locations_raw": (ld_places, css_all("#places .list-place strong")),
        "source_external_job_id": (url_part(r"-(\d+)\.html$"),), "salary_raw": (labelled(".text-muted", "", None, "Mức lương"),),
        "employment_type_raw": (labelled(".text-muted", "", None, "Loại hình"),), "experience_raw": (labelled(".text-muted", "", None, "Kinh nghiệm"),),
        "posted_at": (ld("datePosted"), day(labelled(".text-muted", "", None, "Ngày đăng tuyển"))), "expires_at": (ld("validThrough"), day(labelled(".text-muted", "", None, "Hạn nộp hồ sơ"))),
    }, last_page=page_text("h1", r"([\d.,]+)\s*việc làm", 50), fixed_host=True, listing_id=r"-(\d+)\.html$"),
)}


def _after_node(p: Page, selector: str) -> H.Node | None:
    node = p.root.find(selector)
    body = _next_element(node) if node is not None else None
    if body is None or body.attrs.get("id", "").startswith("section-") or body.find(".job-section-title"):
        return None
    return body


def _after(p: Page, selector: str) -> str | None:
    return H.text_of(_after_node(p, selector))


def _after_items(p: Page, selector: str) -> list[str]:
    body = _after_node(p, selector)
    return H.items_of(body) if body is not None else []


# -- interpreter -----------------------------------------------------------------------------------

_LISTS = ("domains_raw", "categories_raw", "skills_raw", "benefit_items", "locations_raw")
_TEXTS = tuple(x.split()[0] for x in RECORD.split(", ") if x.endswith(" string"))


def first(places: tuple[Place, ...], page: Page) -> Any:
    for place in places:
        got = place(page)
        if got:
            return got
    return None


def extract_record(site: Site, page_html: str | None, url: str | None) -> dict:
    """The canonical record of a detail page; lists are empty and texts null where nothing is found."""
    root = H.parse(page_html)
    posting = H.posting_of(H.json_ld(root)) or {}
    page = Page(root, url or "", posting)
    if site.hydration:
        api = next_data(root)
        page.data = {"job": answer(api, site.hydration[0]), "common": answer(api, site.hydration[1])}
    rules, variant = site.fields, "public_html_json_ld" if posting else "public_html"
    if site.variants:
        rules, variant = {}, "unknown"
        for selector, name, own in site.variants:
            if root.find(selector) is not None:
                rules, variant = own, name
                break
    out: dict[str, Any] = {f: None for f in _TEXTS} | {f: [] for f in _LISTS}
    for name, places in rules.items():
        got = first(places, page)
        if got:
            out[name] = H.unique(got) if name in _LISTS else got
    out["source_variant"] = variant
    issues = [{"field": f, "severity": "info", "code": c, "message": m} for f, c, m in site.infos]
    if site.needs_posting and not posting:
        issues.append({"field": None, "severity": "error", "code": "job_posting_json_ld_not_found", "message": "No JobPosting JSON-LD object was found."})
    if site.variants and variant == "unknown":
        issues.append({"field": None, "severity": "error", "code": "unknown_layout", "message": "The page has none of the known layouts."})
    out["issues"] = issues
    out["source_payload"] = json.dumps({"job_posting_json_ld": posting}, ensure_ascii=False, sort_keys=True) if posting else None
    return out


def canonical_url(site: Site, url: str) -> str:
    parts = urlsplit(url)
    host = site.host if site.fixed_host else parts.netloc
    path = parts.path if site.slash else parts.path.rstrip("/")
    return f"https://{host}{path}" if site.fixed_host else f"{parts.scheme}://{host}{path}"


def listing_urls(site: Site, page_html: str | None, url: str) -> list[str]:
    """Canonical job URLs of a listing page, in order; links to other hosts or paths do not count.

    Each comes once, and where the site says what identifies a listing, the first of each listing."""
    root = H.parse(page_html)
    found: list[str] = []
    if site.item_list:
        found = [u for o in H.json_ld(root) for u in H.item_list_urls(o)]
    for selector in site.listing_links:
        found += [n.attrs.get("href") or n.attrs.get("data-url") or "" for n in root.find_all(selector)]
    out: dict[str, str] = {}
    for link in found:
        full = urljoin(url, link)
        if urlsplit(full).netloc.removeprefix("www.") == site.host.removeprefix("www.") and re.search(site.listing_path, urlsplit(full).path):
            job = canonical_url(site, full)
            own = re.search(site.listing_id, urlsplit(full).path) if site.listing_id else None
            out.setdefault(own[1] if own else job, job)
    return list(dict.fromkeys(out.values()))


def _per_page(pages: DataFrame, schema: str, f: Callable[[Any], list[dict]], columns: list[str]) -> DataFrame:
    ship(pages.sparkSession)
    names = [x.strip().split(" ")[0].split(":")[0] for x in re.split(r",\s*(?![^<]*>)", schema)]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = [r for t in frame.itertuples(index=False) for r in f(t)]
            yield pd.DataFrame(rows, columns=names)

    return pages.select(*columns).mapInPandas(run, schema)


def extract(pages: DataFrame) -> DataFrame:
    """``pages(source, url, html)`` to canonical records with source, url and parser_version.

    Pages of unknown sources come back with an error issue and nothing else.
    """
    def one_page(t) -> list[dict]:
        site = SITES.get(t.source)
        if site is None:
            nothing: dict[str, Any] = {f: None for f in _TEXTS} | {f: [] for f in _LISTS}
            nothing["issues"] = [{"field": None, "severity": "error", "code": "unknown_source", "message": "No rules for this source."}]
            return [nothing | {"source": t.source, "url": t.url, "parser_version": None}]
        return [extract_record(site, t.html, t.url) | {"source": t.source, "url": t.url, "parser_version": site.version}]

    return _per_page(pages, f"source string, url string, parser_version string, {RECORD}", one_page, ["source", "url", "html"])


def discover(pages: DataFrame) -> DataFrame:
    """Listing pages(source, url, html) to (source, listing_url, position, job_url)."""
    def one_page(t) -> list[dict]:
        site = SITES.get(t.source)
        urls = listing_urls(site, t.html, t.url) if site else []
        return [{"source": t.source, "listing_url": t.url, "position": i, "job_url": u} for i, u in enumerate(urls)]

    return _per_page(pages, "source string, listing_url string, position int, job_url string", one_page, ["source", "url", "html"])


def last_pages(pages: DataFrame) -> DataFrame:
    """Listing pages to (source, listing_url, last_page); null where the page does not say."""
    def one_page(t) -> list[dict]:
        site = SITES.get(t.source)
        n = site.last_page(H.parse(t.html), t.url) if site and site.last_page else None
        return [{"source": t.source, "listing_url": t.url, "last_page": n}]

    out = _per_page(pages, "source string, listing_url string, last_page double", one_page, ["source", "url", "html"])
    return out.withColumn("last_page", F.col("last_page").cast("int"))


def host_pattern(site: Site) -> Column:
    """Predicate over ``url``: does it belong to the site?"""
    return F.regexp_extract("url", r"^https?://(?:www\.)?([^/?#]+)", 1) == site.host.removeprefix("www.")
