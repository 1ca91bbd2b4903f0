"""The flattening rules once more, in plain Python over parsed documents, for comparison."""

import re

HEADER = ("reporting_entity_name", "reporting_entity_type", "last_updated_on", "version")
CODES = ("billing_code", "billing_code_type", "billing_code_type_version", "name", "description")


def text(value):
    if value is None:
        return ""
    if isinstance(value, bool):
        return str(value).lower()
    return str(value)


DECIMAL = re.compile(r"\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*\Z")
INTEGER = re.compile(r"\s*[+-]?\d+\s*\Z")


def join(value):
    """A list, or a scalar as a list of one, as text with pipes; nothing for null and empty entries."""
    entries = value if isinstance(value, list) else [value]
    return "|".join(text(entry) for entry in entries if text(entry))


def number(value):
    """The value as a double where it is written as a decimal number."""
    return float(text(value)) if DECIMAL.match(text(value)) else None


def whole(value):
    """The value as an integer where it is written as one."""
    return int(text(value)) if INTEGER.match(text(value)) else None


def provider_rows(source, doc, targets=None, keep_full=False):
    for item in doc.get("provider_references") or []:
        groups = item.get("provider_groups") or []
        start = (source, whole(item.get("provider_group_id")), join(item.get("network_name")))
        cleaned = [
            [text(n).strip() for n in group.get("npi") or [] if n not in (None, "")] for group in groups
        ]
        hit = targets is not None and any(n in targets for npis in cleaned for n in npis)
        if not groups and targets is None:
            yield (*start, "", "", "", "")
        for group, npis in zip(groups, cleaned, strict=True):
            tin = group.get("tin") or {}
            if targets is not None and not (keep_full and hit):
                npis = [n for n in npis if n in targets]
            if not npis and targets is None:
                npis = [""]
            for npi in npis:
                yield (
                    *start,
                    text(tin.get("type")),
                    text(tin.get("value")),
                    npi,
                    text(tin.get("business_name")),
                )


def matched(doc, targets):
    found = set()
    for item in doc.get("provider_references") or []:
        group_id = whole(item.get("provider_group_id"))
        for group in item.get("provider_groups") or []:
            if group_id is not None and any(text(n).strip() in targets for n in group.get("npi") or []):
                found.add(group_id)
    return found


def price_rows(source, doc, groups=None, prefixes=()):
    header = tuple(text(doc.get(h)) for h in HEADER)
    for item in doc.get("in_network") or []:
        fields = (*CODES, "negotiation_arrangement", "severity_of_illness")
        base = (source, *header, *(text(item.get(f)) for f in fields))
        code = text(item.get("billing_code")).strip()
        if groups is not None and prefixes and not code.startswith(tuple(prefixes)):
            continue
        rates = item.get("negotiated_rates") or []
        if not rates and groups is None:
            yield (*base, "", "", None, "", "", "", "", "", None, "")
        for rate in rates:
            refs = rate.get("provider_references") or []
            if groups is not None and not any(whole(r) in groups for r in refs if whole(r) is not None):
                continue
            for price in rate.get("negotiated_prices") or [{}]:
                yield (
                    *base,
                    join(refs),
                    text(price.get("negotiated_type")),
                    number(price.get("negotiated_rate")),
                    text(price.get("expiration_date")),
                    text(price.get("billing_class")),
                    join(price.get("service_code")),
                    join(price.get("billing_code_modifier")),
                    text(price.get("additional_information")),
                    number(price.get("estimated_amount")),
                    text(price.get("setting")),
                )


def out_of_network_rows(source, doc):
    header = tuple(text(doc.get(h)) for h in HEADER)
    for item in doc.get("out_of_network") or []:
        base = (source, *header, *(text(item.get(f)) for f in CODES))
        for amount in item.get("allowed_amounts") or []:
            tin = amount.get("tin") or {}
            start = (
                *base,
                text(tin.get("type")),
                text(tin.get("value")),
                join(amount.get("service_code")),
                text(amount.get("billing_class")),
            )
            for payment in amount.get("payments") or [{}]:
                for provider in payment.get("providers") or [{}]:
                    yield (
                        *start,
                        number(payment.get("allowed_amount")),
                        number(provider.get("billed_charge")),
                        join(provider.get("npi")),
                    )
