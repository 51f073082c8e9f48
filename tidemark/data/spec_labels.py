"""Specification dictionary of the car catalogue: dotted key -> page label.

Fixed values: these keys and labels must equal the catalogue's own so that
the assembled documents match.  Natural order.  Two entries share the label
'中控彩色液晶屏' (one label feeds two keys), and the label of
'light.daytimerunninglight' begins with a TAB character, so it matches only a
label carrying that TAB.
"""

# fixed values (142 entries, 13 groups)
SPEC_LABELS: list[tuple[str, str]] = [
    ("base.price", "厂商指导价"),
    ("base.warrantypolicy", "保修政策"),
    ("base.maxspeed", "最高车速"),
    ("base.comfuelconsumption", "混合工况油耗"),
    ("base.officialaccelerationtime100", "0-100km/h加速时间"),
    ("body.len", "长"),
    ("body.width", "宽"),
    ("body.height", "高"),
    ("body.wheelbase", "轴距"),
    ("body.weight", "整备质量"),
    ("body.seatnumber", "座位数"),
    ("body.luggagevolume", "行李厢容积"),
    ("body.fueltankcapacity", "油箱容积"),
    ("body.color", "车身颜色"),
    ("body.inductionluggage", "电动行李厢"),
    ("body.roofluggagerack", "车顶行李箱架"),
    ("body.sportpackage", "运动外观套件"),
    ("engine.displacementml", "排气量"),
    ("engine.displacement", "排量"),
    ("engine.maxpower", "最大功率"),
    ("engine.maxhorsepower", "最大马力"),
    ("engine.maxpowerspeed", "最大功率转速"),
    ("engine.maxtorque", "最大扭矩"),
    ("engine.maxtorquespeed", "最大扭矩转速"),
    ("engine.cylinderarrangetype", "缸体形式"),
    ("engine.cylindernum", "气缸数"),
    ("engine.intakeform", "进气形式"),
    ("engine.fuelmethod", "供油方式"),
    ("engine.fuelgrade", "燃油标号"),
    ("engine.startstopsystem", "发动机启停"),
    ("engine.environmentalstandards", "环保标准"),
    ("gearbox.gearbox", "变速箱类型"),
    ("gearbox.levelnumber", "挡位个数"),
    ("chassisbrake.drivemode", "驱动方式"),
    ("chassisbrake.frontsuspensiontype", "前悬架类型"),
    ("chassisbrake.rearsuspensiontype", "后悬架类型"),
    ("chassisbrake.adjustablesuspension", "可调悬架"),
    ("chassisbrake.frontbraketype", "前轮制动器类型"),
    ("chassisbrake.rearbraketype", "后轮制动器类型"),
    ("chassisbrake.parkingbraketype", "驻车制动类型"),
    ("chassisbrake.bodystructure", "车体结构"),
    ("chassisbrake.centerdifferentiallock", "限滑差速器/差速锁"),
    ("safe.abs", "防抱死制动(ABS)"),
    ("safe.ebd", "制动力分配(EBD/CBC等)"),
    ("safe.brakeassist", "制动辅助(BA/EBA/BAS等)"),
    ("safe.tractioncontrol", "牵引力控制(ARS/TCS/TRC等)"),
    ("safe.esp", "车身稳定控制(ESP/DSC/VSC等)"),
    ("safe.airbagdrivingposition", "主驾驶安全气囊"),
    ("safe.airbagfrontpassenger", "副驾驶安全气囊"),
    ("safe.airbagfrontside", "前侧气囊"),
    ("safe.airbagrearside", "后侧气囊"),
    ("safe.aircurtainside", "侧安全气帘"),
    ("safe.airbagknee", "膝部气囊"),
    ("safe.airbagseatbelt", "安全带气囊"),
    ("safe.airbagrearcenter", "后排中央气囊"),
    ("safe.tirepressuremonitoring", "胎压监测"),
    ("safe.zeropressurecontinued", "零胎压续行轮胎"),
    ("safe.isointerface", "后排儿童座椅接口(ISO FIX/LATCH)"),
    ("safe.centrallocking", "中控锁"),
    ("safe.intelligentkey", "智能钥匙"),
    ("safe.cruisecontrol", "定速巡航"),
    ("safe.ldws", "车道保持"),
    ("safe.auxiliary", "并线辅助"),
    ("safe.activebraking", "碰撞报警/主动刹车"),
    ("safe.fatiguereminding", "疲劳提醒"),
    ("safe.automaticparkingintoplace", "自动泊车"),
    ("safe.pilotedparking", "遥控泊车"),
    ("safe.autopilotauxiliary", "自动驾驶辅助"),
    ("safe.automaticparking", "自动驻车"),
    ("safe.hillstartassist", "上坡辅助"),
    ("safe.hilldescent", "陡坡缓降"),
    ("safe.nightvisionsystem", "夜视系统"),
    ("safe.vgrs", "可变齿比转向"),
    ("safe.frontparkingradar", "前倒车雷达"),
    ("safe.reversingradar", "后倒车雷达"),
    ("safe.reverseimage", "倒车影像"),
    ("safe.drivemode", "驾驶模式选择"),
    ("doormirror.skylightstype", "天窗类型"),
    ("doormirror.frontelectricwindow", "前电动车窗"),
    ("doormirror.rearelectricwindow", "后电动车窗"),
    ("doormirror.externalmirroradjustment", "外后视镜电动调节"),
    ("doormirror.rearviewmirrorantiglare", "内后视镜自动防眩目"),
    ("doormirror.flowmediummirror", "流媒体后视镜"),
    ("doormirror.externalmirrorantiglare", "外后视镜自动防眩目"),
    ("doormirror.privacyglass", "隐私玻璃"),
    ("doormirror.rearwindowsunshade", "后遮阳帘"),
    ("doormirror.rearsidesunshade", "后排侧遮阳帘"),
    ("doormirror.frontwiper", "前雨刷器"),
    ("doormirror.rearwiper", "后雨刷器"),
    ("doormirror.electricpulldoor", "电吸门"),
    ("wheel.fronttiresize", "前轮胎规格"),
    ("wheel.reartiresize", "后轮胎规格"),
    ("wheel.sparetiretype", "备胎"),
    ("light.headlighttype", "前大灯"),
    ("light.daytimerunninglight", "\tLED日间行车灯"),
    ("light.headlightautomaticopen", "自动大灯"),
    ("light.frontfoglight", "前雾灯"),
    ("light.headlightfunction", "大灯功能"),
    ("internalconfig.material", "内饰材质"),
    ("internalconfig.interiorairlight", "车内氛围灯"),
    ("internalconfig.sunvisormirror", "遮阳板化妆镜"),
    ("internalconfig.steeringwheelmaterial", "方向盘材质"),
    ("internalconfig.steeringwheelmultifunction", "多功能方向盘"),
    ("internalconfig.steeringwheeladjustment", "方向盘调节"),
    ("internalconfig.steeringwheelheating", "方向盘加热"),
    ("internalconfig.steeringwheelexchange", "方向盘换挡"),
    ("seat.seatmaterial", "座椅材质"),
    ("seat.sportseat", "运动风格座椅"),
    ("seat.driverseatelectricadjustment", "主座椅电动调节"),
    ("seat.auxiliaryseatelectricadjustmentmode", "副座椅电动调节"),
    ("seat.driverseatadjustmentmode", "主座椅调节方式"),
    ("seat.auxiliaryseatadjustmentmode", "副座椅调节方式"),
    ("seat.secondrowseatadjustmentectricmode", "第二排座椅电动调节"),
    ("seat.secondrowseatadjustmentmode", "第二排座椅调节方式"),
    ("seat.frontcenterarmrest", "前排中央扶手"),
    ("seat.rearseatcenterarmrest", "后座中央扶手"),
    ("seat.thirdrowseat", "第三排座椅"),
    ("seat.seatdownmode", "座椅放倒方式"),
    ("seat.rearcupholder", "后排杯架"),
    ("entcom.consolelcdscreen", "中控彩色液晶屏"),
    ("entcom.alllcdpanels", "全液晶仪表盘"),
    ("entcom.computerscreen", "行车电脑显示屏"),
    ("entcom.huddisplay", "中控彩色液晶屏"),
    ("entcom.gps", "GPS导航"),
    ("entcom.locationservice", "智能互联定位"),
    ("entcom.voicecontrol", "语音控制"),
    ("entcom.internetos", "手机互联(Carplay&Android)"),
    ("entcom.wirelesscharging", "手机无线充电"),
    ("entcom.gesturecontrol", "手势控制系统"),
    ("entcom.cddvd", "CD/DVD"),
    ("entcom.bluetooth", "蓝牙/WIFI连接"),
    ("entcom.externalinterface", "外接接口"),
    ("entcom.cartv", "车载电视"),
    ("entcom.audiobrand", "音响品牌"),
    ("entcom.speakernum", "扬声器数量"),
    ("entcom.rearlcdscreen", "后排液晶屏/娱乐系统"),
    ("entcom.supplyvoltage", "车载220V电源"),
    ("aircondrefrigerator.frontairconditioning", "前排空调"),
    ("aircondrefrigerator.rearairconditioning", "后排空调"),
    ("aircondrefrigerator.airconditioning", "香氛系统"),
    ("aircondrefrigerator.airpurifyingdevice", "空气净化"),
    ("aircondrefrigerator.carrefrigerator", "车载冰箱"),
]

# Headline level names that differ from the level table.
LEVEL_SYNONYMS: dict[str, str] = {
    "中大型SUV": "大型SUV",
    "卡车": "皮卡",
}

# Markers of the spec sheet (a filled circle = present, '-' = absent).
MARK_PRESENT = "●"
MARK_ABSENT = "-"
